"""Deletion of repeated runs of lines, by winnowing over line hashes.

Method. Of every ``window`` consecutive lines the smallest line hash (the last one of
equals) is selected. Any run of at least ``window`` lines that occurs twice holds a
whole window and therefore selects the same line in both places: the selected lines
are guaranteed fingerprints of repeated runs. The guarantee follows the size of a run: shorter windows,
down to a single line, select too where they have ``long_words`` words, so a passage
that is one or two long lines is found like a run of many short ones. Places of a fingerprint are joined by
its hash; around those found more than once the match is extended line by
line, to the windows that hold the place in each direction, and windows are equal
if all their lines are. What any window repeats from an earlier place is deleted.

Distribution. A fingerprint's and a window's first place are grouped minima, combined
on the map side and joined back; places of one line are never paired with each
other, and the joins split a hot line. Only array and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.session import settle


LONG_WORDS = 50
# A window's start and size travel as one number, and its identity as 64 and 31 bits.
MOST_LINES = 63


def _windows(size: int, window: int, long_words: int) -> str:
    """SQL of an array with the windows of ``size`` lines by their start; null where a shorter one has too few words."""
    each = [f"lines[k + {i}]" for i in range(size)]
    least = f"least({', '.join(f'{x}.h' for x in each)})" if size > 1 else f"{each[0]}.h"
    pick = "CASE " + " ".join(f"WHEN {each[i]}.h = {least} THEN k + {i}" for i in range(size - 1, 0, -1)) + " ELSE k END" if size > 1 else "k"
    cell = (
        f"named_struct('run', k * {MOST_LINES + 1} + {size}, 'pick', {pick}, "
        f"'w', xxhash64({', '.join(f'{x}.h' for x in each)}), 'c', CAST(xxhash64({', '.join(f'{x}.g' for x in each)}) & 2147483647 AS INT))"
    )
    if size < window:
        cell = f"CASE WHEN {' + '.join(f'{x}.n' for x in each)} >= {long_words} THEN {cell} END"
    return f"CASE WHEN size(lines) >= {size} THEN transform(sequence(0, size(lines) - {size}), k -> {cell}) ELSE array() END"


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, window: int, long_words: int) -> DataFrame:
    """Selected lines: (id, hash, line, around): the line hash of a place and the windows that select it."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).filter("id IS NOT NULL AND text IS NOT NULL")
    # Lines with a word: two independent hashes, the number of words and the number among all lines.
    lines = rows.select("id", F.xxhash64("text").alias("hash"), F.expr(
        "filter(transform(split(text, '\\n'), (line, at) -> named_struct("
        "'h', CASE WHEN line rlike '[^ \\\\t-\\\\r]' THEN xxhash64(line) END, 'g', xxhash64(1, line), "
        "'n', regexp_count(line, '[^ \\\\t-\\\\r]+'), 'at', at)), x -> x.h IS NOT NULL)"
    ).alias("lines")).filter("size(lines) > 0")
    sizes = range(1, window + 1)
    cells = lines.select("*", *[F.expr(_windows(size, window, long_words)).alias(f"cells_{size}") for size in sizes])
    picks = ", ".join(f"transform(filter(cells_{size}, x -> x IS NOT NULL), x -> x.pick)" for size in sizes)
    around = ", ".join(
        f"CASE WHEN size(cells_{size}) > 0 THEN filter(transform(sequence(greatest(0, least(p, size(cells_{size}) - 1) - {size - 1}), "
        f"least(p, size(cells_{size}) - 1)), k -> cells_{size}[k]), x -> x.pick = p) ELSE array() END"
        for size in sizes
    )
    prints = F.expr(
        f"transform(array_distinct(concat({picks})), p -> named_struct('line', lines[p].h, "
        f"'around', transform(concat({around}), x -> named_struct('run', x.run, 'w', x.w, 'c', x.c))))"
    )
    return cells.select("id", "hash", F.explode(prints).alias("print")).select("id", "hash", "print.*")


def repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3, long_words: int = LONG_WORDS
) -> DataFrame:
    """(id, hash, runs): per text the windows (start, size) that also begin at an earlier place, by number among lines with words."""
    # Settled sides let the joins see sizes and split a hot line or window at run time.
    prints = settle(_fingerprints(docs, id_col, text_col, window, long_words))
    twice = settle(prints.groupBy("line").agg(F.count(F.lit(1)).alias("places")).filter("places > 1").select("line"))
    found = prints.join(twice, "line", "left_semi").select("id", "hash", F.explode("around").alias("x")).select(
        "id", "hash", F.expr(f"x.run div {MOST_LINES + 1}").cast("int").alias("start"), (F.col("x.run") % (MOST_LINES + 1)).alias("size"), "x.w", "x.c"
    )
    # A text's own places of one window first, then the smallest id that holds it.
    own = settle(found.groupBy("w", "c", "size", "id", "hash").agg(F.array_sort(F.collect_set("start")).alias("starts")))
    first = own.groupBy("w", "c", "size").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("texts"), F.max(F.size("starts")).alias("most"))
    first = settle(first.filter("texts > 1 OR most > 1").select("w", "c", "size", "first"))
    later = own.join(first, ["w", "c", "size"]).withColumn(
        "starts", F.when(F.col("id") > F.col("first"), F.col("starts")).otherwise(F.expr("slice(starts, 2, size(starts))"))
    ).filter(F.size("starts") > 0)
    runs = F.expr("transform(starts, s -> named_struct('start', s, 'size', size))")
    return later.groupBy("id", "hash").agg(F.array_distinct(F.flatten(F.collect_list(runs))).alias("runs"))


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3, counts: bool = True, emptied: bool = True,
    long_words: int = LONG_WORDS,
) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from the text, and ``n_lines`` and ``n_deleted`` with ``counts``.

    A run of at least ``window`` lines, or of fewer with together at least ``long_words`` words, is deleted where it also
    begins at an earlier place: in a document with a smaller id, or further up in the same text. Lines
    without a word are passed over: they neither break nor make a run, and stay.
    Runs are judged on the input, lines are compared as they are, and what is left
    keeps its order. With ``emptied`` false, documents that lose their last word are dropped.

    Null text and null ids stay as they are and do not count as earlier places.
    Rows that repeat an id with the same text lose the same lines, those with another
    text are judged by themselves and delete nothing from each other. Columns called
    ``n_lines`` or ``n_deleted`` are replaced with ``counts``. An empty table gives no rows.
    """
    if not 2 <= window <= MOST_LINES:
        raise ValueError(f"a run has 2 to {MOST_LINES} lines")
    gone = repeated_windows(docs, id_col, text_col, window, long_words).select(
        F.col("id").alias("_id"), F.col("hash").alias("_hash"), F.col("runs").alias("_runs")
    )
    kept = [c for c in docs.columns if not counts or c not in ("n_lines", "n_deleted")]
    # The caller's other columns travel in one struct, so no name of theirs can meet one of these.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept if c != text_col]).alias("doc"),
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    joined = rows.join(gone, (rows["id"] == gone["_id"]) & (F.xxhash64(rows["text"]) == gone["_hash"]), "left")
    numbered = "transform(parts, (line, at) -> struct(line, at))"
    parts = joined.select("doc", "text", F.split("text", "\n").alias("parts"), F.expr(
        "array_distinct(flatten(transform(_runs, r -> sequence(r.start, r.start + r.size - 1))))"
    ).alias("places")).withColumn("numbers", F.expr(
        f"CASE WHEN places IS NOT NULL THEN transform(filter({numbered}, x -> x.line rlike '[^ \\\\t-\\\\r]'), x -> x.at) END"
    ))
    # Filters on the result stop at a number per row: pushed further down, they would split the text anew for every line.
    parts = parts.withColumn("gone", F.expr("transform(places, k -> numbers[k])")).withColumn(
        "row", F.monotonically_increasing_id()
    ).filter("row >= 0")
    if not emptied:
        parts = parts.filter("places IS NULL OR size(numbers) > size(places)")
    left = F.expr("array_join(transform(array_except(sequence(0, size(parts) - 1), gone), k -> parts[k]), '\\n')")
    parts = parts.withColumn("left", F.when(F.col("gone").isNotNull(), left).otherwise(F.col("text")))
    out = [F.col("left").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in kept]
    if counts:
        out.append(F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_lines"))
        out.append(F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"))
    return parts.select(*out)
