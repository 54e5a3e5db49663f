"""Repair of the structure of conversations by cheapest edits, found by bidirectional Dijkstra.

A conversation is well formed if its roles are nothing, or an optional system turn and
then pairs of user and assistant turns. Its edit lattice has a node for every number of rows
done and each of four states (nothing yet, after system, after user, after assistant); keeping,
re-roling or deleting a row leads to the next row, an insertion stays at it. Two
heaps, one from the start and one from the ends, settle nodes by rising cost until their tops sum
up to more than the cheapest crossing; then all crossings of that cost are compared and
the least audit (the edits' initials in order) wins.

Size. Rows are reduced to one letter each (role and fault), equal rows to one with a count,
and conversations are cut into segments of at most 256 letters, so a conversation of any
length is spread over tasks. Of a conversation with several segments, each segment is
summed up by cost and order of its least audits between all states; these
sums combine associatively, level by level, and the states at the cuts go back down.
An insertion at a cut belongs to the segment after it, so audits of different ways
to a cut differ before they end and their order never depends on what follows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.operators.sequences import scan
from loadstone.session import settle

# Letters of a segment, and sums that are combined into one.
SEGMENT = 256
FAN = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (NONE, ASSISTANT)
# What has to be inserted after the last row of a state, and what it costs.
TAIL = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
NEVER = 1 << 60
# Letters of what must be deleted: a row and its copies, or the copies of the row before.
DROPPED = "xy"
BLANKS = " \t\n\x0b\f\r"
# The state after a user or assistant turn put in here, and where it can have come from.
TURN = {NONE: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
BEFORE_TURN = {NONE: (), SYSTEM: (), USER: (NONE, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
_TOKEN = re.compile(r"([a-zA-Z])(\d*)")


# --- one segment ------------------------------------------------------------------


def _keeps(letter: str, state: int) -> int | None:
    """State after a kept row, or None where its role does not fit."""
    role = letter.lower()
    if role == "s":
        return SYSTEM if state == NONE else None
    return TURN[state] if role == ("a" if state == USER else "u") else None


def _forward(rows: list, node: tuple[int, int], closing: bool):
    """(node, cost, initial) of the edits at a node."""
    at, state = node
    if at < len(rows) or closing:
        yield (at, TURN[state]), INSERT, "I"
    if at < len(rows):
        letter, count = rows[at]
        yield (at + 1, state), DELETE * count, "D"
        if letter not in DROPPED:
            extra = TRUNCATED if letter.isupper() else 0
            yield (at + 1, TURN[state]), REROLE + extra, "R"
            kept = _keeps(letter, state)
            if kept is not None:
                yield (at + 1, kept), KEEP + extra, "K"


def _backward(rows: list, node: tuple[int, int], closing: bool):
    """(node before, cost, initial) of the edits that lead to a node."""
    at, state = node
    if at < len(rows) or closing:
        for before in BEFORE_TURN[state]:
            yield (at, before), INSERT, "I"
    if at:
        letter, count = rows[at - 1]
        yield (at - 1, state), DELETE * count, "D"
        if letter not in DROPPED:
            extra = TRUNCATED if letter.isupper() else 0
            for before in STATES:
                if TURN[before] == state:
                    yield (at - 1, before), REROLE + extra, "R"
                if _keeps(letter, before) == state:
                    yield (at - 1, before), KEEP + extra, "K"


class _Side:
    """One of the two searches: settles nodes by cost, then by rows done, so that free edits come in order."""

    def __init__(self, starts, direction: int):
        self.direction, self.heap, self.found, self.settled = direction, [], {}, set()
        for node in starts:
            self.found[node] = (0, "")
            heappush(self.heap, (0, direction * node[0], node))

    def top(self) -> int | None:
        while self.heap and (self.heap[0][2] in self.settled or self.heap[0][0] > self.found[self.heap[0][2]][0]):
            heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self, edits) -> tuple[int, int]:
        node = heappop(self.heap)[2]
        self.settled.add(node)
        cost, audit = self.found[node]
        for other, price, initial in edits(node):
            if other in self.settled:
                continue
            new = (cost + price, audit + initial if self.direction > 0 else initial + audit)
            old = self.found.get(other)
            if old is None or new < old:
                self.found[other] = new
                if old is None or new[0] < old[0]:
                    heappush(self.heap, (new[0], self.direction * other[0], other))
        return node


def solve(rows: list, entry: int, ends: tuple[int, ...], closing: bool) -> tuple[int, str] | None:
    """Least cost and, of that, least audit from state ``entry`` before ``rows`` to one of ``ends`` after them.

    Without ``closing`` nothing is inserted after the last row. None where no edits lead there.
    """
    there = _Side([(0, entry)], 1)
    back = _Side([(len(rows), e) for e in ends], -1)
    best = None
    # Free nodes of the far end go first, so all ends are settled before anything else is.
    while (a := there.top()) is not None:
        b = back.top()
        if b is None and there.settled or None not in (best, b) and a + b > best:
            break
        side, far, edits = (there, back, _forward) if b is None or a < b else (back, there, _backward)
        node = side.settle(lambda n: edits(rows, n, closing))
        cost = side.found[node][0]
        meets = [(node, 0, "")] if node in far.settled else []
        for other, price, _ in [*meets, *edits(rows, node, closing)]:
            if other in far.settled:
                crossing = cost + price + far.found[other][0]
                best = crossing if best is None else min(best, crossing)
    if best is None:
        return None
    audits = []
    for node in there.settled:
        cost, audit = there.found[node]
        if node in back.settled and cost + back.found[node][0] == best:
            audits.append(audit + back.found[node][1])
        for other, price, initial in _forward(rows, node, closing):
            if other in back.settled and cost + price + back.found[other][0] == best:
                audits.append(audit + initial + back.found[other][1])
    return best, min(audits)


def parse(letters: str) -> list[tuple[str, int]]:
    """(letter, count): s, u, a or o by role, upper case if truncated; x or y with a count must be deleted."""
    return [(letter, int(count or 1)) for letter, count in _TOKEN.findall(letters)]


@lru_cache(maxsize=1 << 14)
def whole(letters: str) -> tuple[int, str]:
    """Cost and audit (an initial per edit; a counted letter is one D) of a conversation in one segment."""
    return solve(parse(letters), NONE, ENDS, True)


@lru_cache(maxsize=1 << 12)
def sums(letters: str) -> tuple[list[int], list[int]]:
    """Costs between all states, and the place of each audit among those from the same state."""
    rows, costs, places = parse(letters), [], []
    for entry in STATES:
        found = [solve(rows, entry, (end,), False) for end in STATES]
        order = sorted({f[1] for f in found if f})
        costs += [f[0] if f else NEVER for f in found]
        places += [order.index(f[1]) if f else 0 for f in found]
    return costs, places


@lru_cache(maxsize=1 << 12)
def part(letters: str, entry: int, end: int) -> str:
    return solve(parse(letters), entry, (end,), False)[1]


# --- several segments ---------------------------------------------------------------


def _advance(reached: dict, costs: list[int], places: list[int]) -> tuple[dict, dict]:
    """From (cost, place) per state to that after one more segment, and the state each came from."""
    options = {
        end: min(
            ((c + costs[4 * s + end], p, places[4 * s + end], s) for s, (c, p) in reached.items() if costs[4 * s + end] < NEVER),
            default=None,
        )
        for end in STATES
    }
    options = {end: o for end, o in options.items() if o}
    order = sorted({(p, q) for _, p, q, _ in options.values()})
    return {e: (o[0], order.index(o[1:3])) for e, o in options.items()}, {e: o[3] for e, o in options.items()}


def combine(parts: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """The sums of consecutive segments taken together."""
    costs, places = [], []
    for entry in STATES:
        reached = {entry: (0, 0)}
        for c, p in parts:
            reached, _ = _advance(reached, c, p)
        costs += [reached.get(e, (NEVER, 0))[0] for e in STATES]
        places += [reached.get(e, (NEVER, 0))[1] for e in STATES]
    return costs, places


def cuts(parts: list[tuple[list[int], list[int]]], entry: int, end: int) -> list[int]:
    """States after each of consecutive segments on the best way from ``entry`` to ``end``."""
    reached, came = {entry: (0, 0)}, []
    for c, p in parts:
        reached, back = _advance(reached, c, p)
        came.append(back)
    states = [end]
    for back in reversed(came[1:]):
        states.append(back[states[-1]])
    return states[::-1]


def _sorted_parts(table: pa.Table) -> tuple[pa.Table, list]:
    table = table.sort_by("segment")
    return table, list(zip(table["costs"].to_pylist(), table["places"].to_pylist()))


def _states_at_cuts(sums_of: DataFrame, key_type: str) -> DataFrame:
    """(conv, segment, entry, end) of each segment of the conversations, from (conv, segment, costs, places)."""

    def up(table: pa.Table) -> pa.Table:
        table, parts = _sorted_parts(table)
        costs, places = combine(parts)
        return pa.table({
            "conv": table["conv"].slice(0, 1), "segment": table["parent"].slice(0, 1),
            "costs": pa.array([costs], pa.list_(pa.int64())), "places": pa.array([places], pa.list_(pa.int64())),
        })

    def down(table: pa.Table) -> pa.Table:
        table, parts = _sorted_parts(table)
        entry, end = table["entry"][0].as_py(), table["end"][0].as_py()
        after = cuts(parts, entry, end)
        return pa.table({
            "conv": table["conv"], "segment": table["segment"],
            "entry": pa.array([entry, *after[:-1]], pa.int32()), "end": pa.array(after, pa.int32()),
        })

    levels, last = [sums_of], sums_of.agg(F.max("segment")).first()[0] or 0
    parent = F.expr(f"segment div {FAN}").alias("parent")
    while last:
        grouped = levels[-1].select("*", parent).groupBy("conv", "parent")
        levels.append(settle(grouped.applyInArrow(up, f"conv {key_type}, segment long, costs array<long>, places array<long>")))
        last //= FAN
    ends = F.array_min(F.array(*[
        F.struct((F.col("costs")[s] + INSERT * len(TAIL[s])).alias("cost"), F.col("places")[s].alias("place"), F.lit(s).alias("end"))
        for s in STATES
    ]))["end"]
    states = levels[-1].select("conv", "segment", F.lit(NONE).alias("entry"), ends.alias("end"))
    for level in reversed(levels[:-1]):
        above = states.select(F.col("conv").alias("_conv"), F.col("segment").alias("_parent"), "entry", "end")
        level = level.select("*", parent)
        joined = level.join(above, level["conv"].eqNullSafe(above["_conv"]) & (F.col("parent") == F.col("_parent")))
        states = settle(joined.groupBy("conv", "parent").applyInArrow(down, f"conv {key_type}, segment long, entry int, end int"))
    return states


# --- conversations ------------------------------------------------------------------


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text) without nulls in role and text."""
    filled = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text)]
    return turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), filled[0].alias("role"), filled[1].alias("text"))


def _same() -> Column:
    """Names role and text of a row; the length keeps the two apart."""
    return F.md5(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text")).alias("same")


def _on(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[f"_{name}"])
    return condition


def _units(rows: DataFrame) -> DataFrame:
    """Distinct rows in order inside their conversation: number, letters, and what they add to the report."""
    tail = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = rows.select(
        "conv", "turn", F.substring("role", 1, 40).alias("role_head"), F.substring("text", 1, 40).alias("text_head"), _same(),
        F.substring("role", 1, 1).alias("initial"), (tail == "").alias("empty"), (~F.right(tail, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    order = ["role_head", "text_head", "same"]
    units = settle(light.groupBy("conv", "turn", *order, "initial", "empty", "cut").agg(F.count(F.lit(1)).alias("copies")))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeats = settle(
        units.groupBy("conv", "same").agg(F.min(when).alias("when"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(F.col("conv").alias("_conv"), F.col("same").alias("_same"), F.col("when.turn").alias("_first"))
    )
    joined = units.join(repeats, units["conv"].eqNullSafe(repeats["_conv"]) & (F.col("same") == F.col("_same")), "left")
    first = F.col("_same").isNull() | F.col("turn").eqNullSafe(F.col("_first"))
    zero, copies = F.lit(0), F.col("copies")
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    judged = joined.select(
        "conv", "turn", *order, "initial", "copies",
        F.when(F.col("empty"), copies).otherwise(zero).alias("blank"),
        F.when(F.col("empty"), zero).when(first, copies - 1).otherwise(copies).alias("duplicate"),
        F.when(~F.col("empty") & first & F.col("cut"), 1).otherwise(zero).alias("truncated"),
        F.when(F.col("empty") | ~first, F.concat(F.lit("x"), copies.cast("string"))).otherwise(
            F.concat(F.when(F.col("cut"), F.upper(kind)).otherwise(kind), F.when(copies > 1, F.concat(F.lit("y"), (copies - 1).cast("string"))).otherwise(""))
        ).alias("letters"),
    )
    placed = scan(
        judged, ["conv"], [F.col("turn").asc_nulls_first(), *order], number="number",
        lags={"role_before": F.col("initial"), "turn_before": F.col("turn")}, totals={"units": F.lit(1)},
    )
    pair = F.concat("role_before", "initial")
    return placed.withColumns({
        "illegal": copies - 1 + F.when((F.col("number") > 1) & ~pair.isin("su", "ua", "au"), 1).otherwise(0),
        "new_turn": F.when(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before")), 1).otherwise(0),
        "segment": F.expr(f"(number - 1) div {SEGMENT}"),
    })


REPORT = ("blank", "duplicate", "truncated", "illegal")


class Repair:
    """Cheapest repair of every conversation of ``turns``.

    The rows of a conversation are taken by turn (nulls first), equal turns by
    role and text: by the first 40 characters of each, then by a hash of the whole, so equal rows
    are neighbours. The first fault of a row counts: blank (nothing but blanks), duplicate (role
    and text seen before in the conversation), truncated (last character that is no blank is none of . ! ?).

    Edits: keep costs 0, re-role to user or assistant 1, delete 2 (the only one for blank and duplicate
    rows), insert an empty user or assistant turn 5; a truncated row that stays costs 5 more. Initials of
    roles decide; a row with an empty role cannot be kept as it is.

    Null role or text: one space. Null turn: before all others, and no gap. Rows with a null
    conversation form one conversation. Repeated rows are duplicates. Other columns are not read, so their names
    cannot clash. An empty table gives no rows.
    """

    def __init__(self, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.names = conv, turn, role, text
        self.rows = _rows(turns, conv, turn, role, text)
        self.key_type = self.rows.schema["conv"].dataType.simpleString()
        self.units = settle(_units(self.rows))
        self.segments = self._edits()

    def _edits(self) -> DataFrame:
        """(conv, segment, letters, entry, edits, cost and the report's sums) of each segment."""
        ordered = F.array_sort(F.collect_list(F.struct("number", "letters")))
        segments = settle(self.units.groupBy("conv", "segment").agg(
            F.array_join(F.transform(ordered, lambda u: u["letters"]), "").alias("letters"), F.max("units").alias("units"),
            *[F.sum(c).alias(c) for c in (*REPORT, "new_turn")], F.min("turn").alias("low"), F.max("turn").alias("high"),
        ))
        several = segments.filter(F.col("units") > SEGMENT)
        long = pa.list_(pa.int64())

        def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [sums(letters) for letters in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([c for c, _ in found], long), pa.array([p for _, p in found], long)],
                    names=["conv", "segment", "costs", "places"],
                )

        sums_of = settle(several.select("conv", "segment", "letters").mapInArrow(
            sum_up, f"conv {self.key_type}, segment long, costs array<long>, places array<long>"
        ))
        states = _states_at_cuts(sums_of, self.key_type).select(
            F.col("conv").alias("_conv"), F.col("segment").alias("_segment"), "entry", "end"
        )
        joined = segments.join(states, _on(segments, states, ["conv", "segment"]), "left").drop("_conv", "_segment")

        def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = batch.schema.names
                out = []
                for letters, entry, end, last in zip(*(batch.column(names.index(c)).to_pylist() for c in ("letters", "entry", "end", "last"))):
                    if entry is None:
                        out.append(whole(letters)[1])
                    else:
                        out.append(part(letters, entry, end) + (TAIL[end] if last else ""))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, "edits"])

        last = (F.col("segment") == F.expr(f"(units - 1) div {SEGMENT}")).alias("last")
        frame = joined.select("*", last)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
        return settle(frame.mapInArrow(edit, f"{fields}, edits string"))

    def report(self) -> DataFrame:
        """Per conversation: gaps, counts of faults, illegal neighbours, cost of the repair and its audit."""

        def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                audits, costs = [], []
                for letters, edits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    rows, out, cost, at = parse(letters), [], 0, 0
                    for edit in edits:
                        letter, count = ("x", 1) if edit == "I" else rows[at]
                        at += edit != "I"
                        out.append(edit * count)
                        cost += INSERT if edit == "I" else DELETE * count if edit == "D" else (edit == "R") + TRUNCATED * letter.isupper()
                    audits.append("".join(out))
                    costs.append(cost)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[2:], pa.array(audits, pa.string()), pa.array(costs, pa.int64())], names=[*batch.schema.names[2:], "audit", "cost"]
                )

        kept = ["conv", "segment", *REPORT, "new_turn", "low", "high"]
        frame = self.segments.select("letters", "edits", *kept)
        fields = ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in kept)
        priced = frame.mapInArrow(price, f"{fields}, audit string, cost long")
        audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda s: s["audit"]), "")
        total = priced.groupBy("conv").agg(
            *[F.sum(c).cast("long").alias(c) for c in (*REPORT, "cost", "new_turn")], F.min("low").alias("low"), F.max("high").alias("high"), audit.alias("audit")
        )
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("new_turn"), F.lit(0)).cast("long")
        return total.select(F.col("conv").alias(self.names[0]), gaps.alias("gaps"), *REPORT, "cost", "audit")

    def repaired(self) -> DataFrame:
        """The rows after the repair: conversation, ``place`` (rising, with gaps), role and text."""
        conv, _, role, text = self.names

        def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                which, numbers, places, roles = [], [], [], []
                for n, (segment, letters, entry, edits) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3, 4)))):
                    rows, state, at, number = parse(letters), entry or NONE, 0, segment * SEGMENT
                    for index, edit in enumerate(edits):
                        letter = "" if edit == "I" else rows[at][0]
                        at += edit != "I"
                        number += letter not in ("", "y")
                        if edit == "D":
                            continue
                        state = _keeps(letter, state) if edit == "K" else TURN[state]
                        which.append(n)
                        numbers.append(None if edit == "I" else number)
                        places.append((segment << 20) + index)
                        roles.append(None if edit == "K" else "user" if state == USER else "assistant")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(which, pa.int64())), pa.array(numbers, pa.int64()), pa.array(places, pa.int64()), pa.array(roles, pa.string())],
                    names=["conv", "number", "place", "new_role"],
                )

        edits = settle(self.segments.select("conv", "segment", "letters", "entry", "edits").mapInArrow(
            follow, f"conv {self.key_type}, number long, place long, new_role string"
        ))
        stays = edits.filter("number IS NOT NULL").withColumnsRenamed({"conv": "_conv", "number": "_number"})
        units = self.units.select("conv", "number", "turn", "same")
        stays = settle(units.join(stays, _on(units, stays, ["conv", "number"])).select(
            F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), F.col("same").alias("_same"), "place", "new_role"
        ))
        texts = self.rows.select("*", _same()).groupBy("conv", "turn", "same").agg(F.first("role").alias("role"), F.first("text").alias("text"))
        found = texts.join(stays, _on(texts, stays, ["conv", "turn", "same"])).select(
            "conv", "place", F.coalesce("new_role", "role").alias("role"), "text"
        )
        put_in = edits.filter("number IS NULL").select("conv", "place", F.col("new_role").alias("role"), F.lit("").alias("text"))
        return found.unionByName(put_in).select(
            F.col("conv").alias(conv), "place", F.col("role").alias(role), F.col("text").alias(text)
        )


def digests(rows: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """(``conv``, sha256) over the lines ``role:text`` of each conversation in order of ``place``.

    A hash has to see a conversation's lines one after another: they are sorted on disk and stream
    through a task that holds one batch.
    """
    key_type = rows.schema[conv].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def done():
            return pa.RecordBatch.from_arrays([now, pa.array([digest.hexdigest()])], names=["conv", "sha256"])

        for batch in batches:
            keys = batch.column(0)
            for n, (r, t) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                line = f"{r}:{t}".encode("utf-8", "surrogatepass")
                if digest is not None and keys[n] == now[0]:
                    digest.update(b"\n" + line)
                    continue
                if digest is not None:
                    yield done()
                now, digest = keys.slice(n, 1), hashlib.sha256(line)
        if digest is not None:
            yield done()

    ordered = rows.repartition(conv).sortWithinPartitions(conv, "place")
    hashes = ordered.select(conv, role, text).mapInArrow(read, f"conv {key_type}, sha256 string")
    return hashes.withColumnRenamed("conv", conv)


def damage(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text), some of them dropped, emptied, stripped, repeated or re-roled by a hash of their place."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    kind = (F.crc32(F.concat_ws(":", *shown)) % 20).alias("_kind")
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind).filter("_kind <> 0")
    stripped = F.regexp_replace("text", "[.!?]", "")
    return rows.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, stripped).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
