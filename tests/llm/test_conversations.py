"""Repairs against a plain search over all edits, in one segment and in many."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from loadstone.llm import conversations as C
from loadstone.llm.catalog import QUERIES

BLANK = " \t\n\x0b\f\r"


def cheapest(rows):
    """(cost, audit, lines) by a plain table over (row, state) with all insertions tried; rows: (role, text, gone, cut)."""
    after = {"": "u", "s": "u", "a": "u", "u": "a"}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                new = (cost + 5, audit + "I", lines + [("user" if after[state] == "u" else "assistant") + ":"])
                best[after[state]] = min(best.get(after[state], new), new)
        return best

    best = insert({"": (0, "", [])})
    for role, text, gone, cut in rows:
        new = {}

        def offer(state, way):
            new[state] = min(new.get(state, way), way)

        for state, (cost, audit, lines) in best.items():
            offer(state, (cost + 2, audit + "D", lines))
            if not gone:
                extra = 5 * cut
                if role[:1] == after[state] or role[:1] == "s" and state == "":
                    offer(role[:1], (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
                offer(after[state], (cost + 1 + extra, audit + "R", [*lines, ("user" if after[state] == "u" else "assistant") + f":{text}"]))
        best = insert(new)
    return min(best[s] for s in ("", "a") if s in best)


def plain(turns, damaged=False):
    """The query's rows for (conv, turn, role, text)."""
    by_conv = {}
    for conv, turn, role, text in turns:
        rows = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        if damaged:
            shown = [" " if v is None else str(v) for v in (conv, turn)]
            kind = zlib.crc32(":".join(shown).encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            role = "user" if kind == 4 else role
            rows += [(turn, role, text)] * (kind == 3)
        rows.append((turn, role, text))
    out = []
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            bare = text.strip(BLANK)
            faults = [not bare, (role, text) in seen, bool(bare) and bare[-1] not in ".!?"]
            seen.add((role, text))
            if True in faults:
                counts[faults.index(True)] += 1
            judged.append((role, text, faults[0] or faults[1], faults[2]))
        turns_known = {t for t, _, _ in rows if t is not None}
        gaps = max(turns_known) - min(turns_known) + 1 - len(turns_known) if turns_known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(judged)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def report(spark, turns):
    frame = spark.createDataFrame(turns, SCHEMA)
    repair = C.Repair(frame)
    hashes = {r.conv_id: r.sha256 for r in C.digests(repair.repaired()).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return sorted([(*r, hashes.get(r.conv_id, nothing)) for r in repair.report().collect()], key=repr)


def made(rng, conversations, most):
    turns = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!", "Cut off", "", " \n", None, f"Own {turn}.", f"Own {turn}?\n", f"own {turn}"])
            turns.append((conv, rng.choice([turn, turn, turn, turn * 2, None]), role, text))
            if rng.random() < 0.1:
                turns.append(turns[-1])
    return turns


def test_least_audits_of_small_lattices():
    rng = random.Random(5)
    for _ in range(400):
        letters = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(0, 9)))
        rows = [({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "other"), "t", c == "x", c.isupper()) for c in letters]
        assert C.whole(letters) == cheapest(rows)[:2], letters


def test_exhaustive_search_agrees():
    """All edit sequences of up to two insertions in a row, tried one by one."""

    @lru_cache(None)
    def ways(letters, state):
        found = {(0, "")} if not letters and state in C.ENDS else set()
        for inserted, after in ((0, state), (1, C.TURN[state]), (2, C.TURN[C.TURN[state]])):
            if inserted and not letters and after in C.ENDS:
                found.add((5 * inserted, "I" * inserted))
            if letters:
                head = letters[0]
                steps = [(2, "D", after)]
                if head not in "xy":
                    extra = 5 * head.isupper()
                    steps.append((1 + extra, "R", C.TURN[after]))
                    if C._keeps(head, after) is not None:
                        steps.append((extra, "K", C._keeps(head, after)))
                found |= {(5 * inserted + c + d, "I" * inserted + e + rest) for c, e, s in steps for d, rest in ways(letters[1:], s)}
        return frozenset(found)

    rng = random.Random(6)
    for _ in range(60):
        letters = "".join(rng.choice("suaoSUAx") for _ in range(rng.randrange(1, 5)))
        assert C.whole(letters) == min(ways(letters, C.NONE)), letters


def test_segments_give_what_one_lattice_gives():
    rng = random.Random(7)
    for _ in range(60):
        letters = "".join(rng.choice("suuaaoUAx") for _ in range(rng.randrange(4, 30)))
        pieces = [letters[k : k + 4] for k in range(0, len(letters), 4)]
        parts = [C.sums(p) for p in pieces]
        both = [C.combine(parts[:3]), *parts[3:]]
        costs, places = C.combine(both)
        end = min((costs[s] + 5 * len(C.TAIL[s]), places[s], s) for s in C.STATES)[2]
        states = C.cuts(parts, C.NONE, end)
        audit = "".join(C.part(p, a, b) for p, a, b in zip(pieces, [C.NONE, *states], states)) + C.TAIL[end]
        assert (costs[end] + 5 * len(C.TAIL[end]), audit) == C.whole(letters)


@pytest.mark.parametrize("segment, fan", [(256, 1024), (5, 1024), (2, 2)])
def test_equals_plain(spark, monkeypatch, segment, fan):
    monkeypatch.setattr(C, "SEGMENT", segment)
    monkeypatch.setattr(C, "FAN", fan)
    turns = made(random.Random(segment), 25, 14)
    turns += [(None, n % 5, "user" if n % 2 else "assistant", f"Of nobody {n % 11}.") for n in range(40)]
    assert report(spark, turns) == plain(turns)


def test_a_conversation_with_a_third_of_all_rows(spark):
    rng = random.Random(2)
    turns = [(7, n, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Turn {n}.", f"cut {n}"])) for n in range(1500)]
    turns += [(8, 3, "user", "Equal rows.")] * 1200 + made(rng, 60, 9)
    turns += [(c, t, r, x) for c, t, r, x in made(rng, 5, 9) if c not in (7, 8)]
    assert report(spark, turns) == plain(turns)


def test_nothing_and_clashing_columns(spark):
    frame = spark.createDataFrame([], SCHEMA + ", segment long, letters string")
    repair = C.Repair(frame)
    assert repair.report().collect() == [] and C.digests(repair.repaired()).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "A."), (1, 1, "assistant", "x" * 300_000 + ".")], SCHEMA)
    clashing = rows.selectExpr("*", "1 AS conv", "2 AS same", "3 AS place", "4 AS number", "'q' AS _conv")
    got = C.Repair(clashing).report().collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "KK")]


def test_query_equals_plain(spark, tmp_path, sf_dir):
    turns = made(random.Random(11), 150, 10) + [(500 + n, 0, "user", "Only.") for n in range(40)]
    turns += [(None, None, "user", None), (None, 2, None, "Text."), (3, None, None, None)]
    spark.createDataFrame(turns, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted([tuple(r) for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()], key=repr)
    ids = {c for c, *_ in turns}
    expected = plain(turns, damaged=True)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == sorted(expected + [(c, *nothing) for c in ids - {e[0] for e in expected}], key=repr)
