"""Best-fit packing of pieces into sequences, planned on the histogram of lengths.

Sequences of equal free space are interchangeable, and so are pieces of equal
length. The plan therefore runs over counts: lengths from long to short, each
put into the sequences with the least free space that still holds it, whole
runs of sequences at a time. Its size depends on the capacity only (see
``plan``), never on the number of pieces. A piece then takes the slot of its
rank within its length: ranks come from one range partitioning by length, in
which a frequent length spreads over many tasks.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadstone.session import settle

Slot = tuple[int, int, int, int, int]


def plan(histogram: dict[int, int], capacity: int) -> list[Slot]:
    """(length, rank from, rank to, first sequence, offset): ranks from..to-1 take consecutive sequences.

    Best-fit decreasing. A step uses up a run of sequences or a length; new runs
    are opened at most once per length, so there are at most capacity * (1 + ln capacity) * 2
    rows or so, whatever the counts are.
    """
    slots: list[Slot] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    free: list[int] = []
    used = 0

    def put(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in runs:
                runs[space] = []
                insort(free, space)
            runs[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit a sequence of {capacity}")
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(free, length)
            if at == len(free):
                break
            space = free[at]
            first, count = runs[space].pop()
            taken = min(left, count)
            slots.append((length, rank, rank + taken, first, capacity - space))
            if taken < count:
                runs[space].append((first + taken, count - taken))
            if not runs[space]:
                del runs[space]
                free.pop(at)
            put(space - length, first, taken)
            rank, left = rank + taken, left - taken
        each = capacity // length
        for count, fill in ((left // each, each), (1, left % each)):
            if not count or not fill:
                continue
            for k in range(fill):
                slots.append((length, rank, rank + count, used, k * length))
                rank += count
            put(capacity - fill * length, used, count)
            used += count
    return slots


def pack(pieces: DataFrame, order: list[str], length: str = "length", capacity: int = 2048) -> DataFrame:
    """All columns of ``pieces`` with ``sequence_id`` and ``offset``; sequences have no gaps.

    ``order`` names columns that rank pieces of one length; ties may be broken
    either way. A null length is a piece of no tokens and an error, as is one
    above the capacity. An empty table gives no rows. Columns called
    ``sequence_id`` or ``offset`` are replaced.
    """
    spark = pieces.sparkSession
    pieces = settle(pieces.drop("sequence_id", "offset"))
    histogram = {row[0]: row[1] for row in pieces.groupBy(length).agg(F.count(F.lit(1))).collect()}
    if None in histogram:
        raise ValueError("a piece has no length")
    slots = plan(histogram, capacity)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The caller's columns travel in one struct, so no name of theirs can meet one of these.
    ranks = [f"order_{i}" for i in range(len(order))]
    rows = pieces.select(
        F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("piece"), F.col(f"`{length}`").cast("long").alias("size"),
        *[F.col(f"`{c}`").alias(r) for c, r in zip(order, ranks)],
    )
    # Written down, as a range partitioning that runs again may cut elsewhere.
    placed = settle(
        rows.repartitionByRange(parts, "size", *ranks).sortWithinPartitions("size", *ranks)
        .select("piece", "size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    )
    # Each part holds a stretch of lengths: at most parts + capacity rows.
    starts = placed.groupBy("part", "size").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("count"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("part", "size", (F.coalesce(F.sum("count").over(before), F.lit(0)) - F.col("low")).alias("base"))
    ranked = placed.join(F.broadcast(starts), ["part", "size"]).select("piece", "size", (F.col("at") + F.col("base")).alias("rank"))
    # Bounded by the capacity, see plan.
    table = spark.createDataFrame(slots, "len long, from long, to long, first long, offset long")
    return ranked.join(
        F.broadcast(table), (F.col("size") == F.col("len")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to"))
    ).select("piece.*", (F.col("first") + F.col("rank") - F.col("from")).alias("sequence_id"), "offset")
