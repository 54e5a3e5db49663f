"""Approximate nearest neighbours by an adaptive dimension scan inside probed lists.

Vectors lie in lists around k-means centres. A task holds one chunk of a list,
rotated by a random orthogonal matrix and stored by blocks of columns. For each
query that probes the list, distances grow block by block; after each block a
hypothesis test compares the partial distance with the distance to beat and
abandons the candidates that are, at that confidence, too far. What survives all
blocks is measured on the original vectors in double precision.

Distribution. Centres are fitted on a bounded sample, every vector is indexed.
Equal vectors are searched once and keep their smallest ids only, as many as any
answer can show; that is exact, and a vector that fills a third of the table
costs one candidate. Lists and the queries that probe them are cut into chunks
of bounded size.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstone.session import settle

# Rows the centres are fitted on, at most.
SAMPLE_ROWS = 20_000
MOST_LISTS = 4096
COLUMNS = 16
# Confidence of the abandoning test; larger abandons less.
EPSILON = 2.1
CHUNK_ROWS, CHUNK_QUERIES = 16_384, 4_096
SCHEMA = "query long, member long, score double"


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    raw = column.combine_chunks()
    return np.frombuffer(b"".join(raw.to_pylist()), dtype=np.float64).reshape(-1, width)


def _fit(sample: np.ndarray, lists: int, seed: int, rounds: int = 10) -> np.ndarray:
    """k-means centres of the sample."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        near = _squared(sample, centres).argmin(axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=lists)
        np.add.at(sums, near, sample)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def _squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None] - 2 * left @ right.T


def scan(candidates: np.ndarray, columns: np.ndarray, query: np.ndarray, rotated: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, exact distances) of candidates that may be among the ``most`` nearest.

    ``candidates``: original rows. ``columns``: the rotated vectors, dimension by row.
    """
    width, total = columns.shape
    found, scores = np.empty(0, dtype=np.int64), np.empty(0)
    limit, at, step = np.inf, 0, 4 * most
    while at < total:
        alive = np.arange(at, min(total, at + step))
        partial = np.zeros(len(alive))
        for low in range(0, width, COLUMNS):
            high = min(low + COLUMNS, width)
            # Only what is still alive is read of the further columns.
            block = columns[low:high, alive[0] : alive[-1] + 1] if len(alive) == alive[-1] - alive[0] + 1 else columns[low:high, alive]
            partial += ((block - rotated[low:high, None]) ** 2).sum(axis=0)
            if high < width and limit < np.inf:
                stay = partial <= (1 + EPSILON / sqrt(high)) ** 2 * high / width * limit**2
                alive, partial = alive[stay], partial[stay]
                if not len(alive):
                    break
        at, step = at + step, min(2 * step, 4096)
        if not len(alive):
            continue
        exact = np.sqrt(((candidates[alive] - query) ** 2).sum(axis=1))
        found, scores = np.concatenate([found, alive]), np.concatenate([scores, exact])
        if len(scores) > most:
            edge = np.partition(scores, most - 1)[most - 1]
            stay = scores <= edge
            found, scores, limit = found[stay], scores[stay], edge
    return found, scores


def _usable(vector: Column, width: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == width) & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    probe_share: float = 0.85, sample_rows: int = SAMPLE_ROWS, seed: int = 7,
) -> DataFrame:
    """Per query: its ``k`` nearest other rows found: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``is_query`` selects the queries; every row but a query's own is a
    candidate. ``score`` is the Euclidean distance of the original vectors; ties go
    to the smaller id. There are sqrt(rows) / 2 lists, at most 4096, and a query
    probes the nearest ``probe_share`` of them: vectors without any structure need a
    large share for a recall above 0.9, clustered ones far less.

    Vectors that are null, zero, hold null or non-finite parts, or have another
    number of parts than most rows take no part, nor do null ids. An id that
    repeats with one vector counts once; with several vectors, each is a candidate
    and a query. Other columns are not read. No usable rows give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter("id IS NOT NULL AND vector IS NOT NULL")
    common = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if common is None or not common["width"]:
        return spark.createDataFrame([], result)
    width = common["width"]
    # Adding zero makes -0.0 equal to 0.0.
    rows = rows.filter(_usable(F.col("vector"), width)).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))

    # The smallest ids of each distinct vector: one more than an answer can show, as the query's own may be among them.
    by_vector = Window.partitionBy("vector").orderBy("id")
    ids = rows.select("vector", "id").distinct()
    kept = settle(ids.withColumn("at", F.row_number().over(by_vector)).filter(F.col("at") <= k + 1))
    distinct = kept.filter("at = 1").select(F.col("id").alias("head"), "vector")
    asking = settle(
        rows.filter("asks").select("id", "vector").distinct().join(distinct, "vector").select("id", "head")
    )

    total = distinct.count()
    if not total:
        return spark.createDataFrame([], result)
    share = min(1.0, 1.2 * sample_rows / total)
    drawn = (
        distinct.filter(F.pmod(F.xxhash64("head", "vector"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .orderBy(F.xxhash64("head", "vector")).limit(sample_rows).select("vector").toPandas()
    )
    sample = np.array(drawn["vector"].tolist(), dtype=np.float64).reshape(-1, width)
    if not len(sample):
        sample = np.zeros((1, width))
    lists = max(1, min(MOST_LISTS, int(sqrt(total) / 2), len(sample)))
    centres = _fit(sample, lists, seed)
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))[0]
    probes = max(1, ceil(probe_share * lists))

    def assign(count: int):
        def run(batches):
            for batch in batches:
                raw = np.array(batch.column(1).flatten(), dtype=np.float64).reshape(-1, width)
                if not len(raw):
                    continue
                squared = _squared(raw, centres)
                if count == 1:
                    near = squared.argmin(axis=1)[:, None]
                else:
                    near = np.argpartition(squared, count - 1, axis=1)[:, :count]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(batch.column(0).to_numpy(), count), pa.int64()),
                    pa.array(near.ravel(), pa.int64()),
                    pa.array([row.tobytes() for row in raw for _ in range(count)], pa.binary()),
                ], names=["head", "list", "vector"])

        return run

    indexed = settle(distinct.select("head", "vector").mapInArrow(assign(1), "head long, list long, vector binary"))
    heads = asking.select("head").distinct()
    asked = settle(
        distinct.join(heads, "head", "left_semi").select("head", "vector")
        .mapInArrow(assign(probes), "head long, list long, vector binary")
    )
    # At most one row per list.
    chunks = indexed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("parts")).join(
        asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK_QUERIES).alias("slices")), "list"
    )
    part = F.pmod(F.xxhash64("head"), F.col("parts"))
    piece = F.pmod(F.xxhash64("head"), F.col("slices"))
    stored = indexed.join(F.broadcast(chunks), "list").select(
        "list", part.alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "head", "vector"
    )
    probing = asked.join(F.broadcast(chunks), "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), piece.alias("slice"), "head", "vector"
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[pd.DataFrame] = []
        if left.num_rows and right.num_rows:
            members, queries = _matrix(left["vector"], width), _matrix(right["vector"], width)
            columns = np.ascontiguousarray((members @ rotation).T)
            turned = queries @ rotation
            names = left["head"].to_numpy()
            for i, head in enumerate(right["head"].to_numpy()):
                found, scores = scan(members, columns, queries[i], turned[i], k + 1)
                out.append(pd.DataFrame({"query": head, "member": names[found], "score": scores}))
        empty = pd.DataFrame({"query": pd.Series(dtype="int64"), "member": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pa.Table.from_pandas(pd.concat(out) if out else empty, preserve_index=False)

    keys = ("list", "part", "slice")
    pairs = stored.groupBy(*keys).cogroup(probing.groupBy(*keys)).applyInArrow(search, SCHEMA)
    by_query = Window.partitionBy("query").orderBy("score", "member")
    top = pairs.withColumn("at", F.row_number().over(by_query)).filter(F.col("at") <= k + 1).drop("at")
    # Back from distinct vectors to rows: k + 1 of them at most, with k + 1 ids each.
    ids = kept.join(distinct.select("head", F.col("vector").alias("_vector")), F.col("vector") == F.col("_vector")).select("head", "id")
    spread = top.join(ids, F.col("member") == F.col("head")).select("query", "id", "score")
    by_query = Window.partitionBy("query").orderBy("score", "id")
    # Settled, so that the join can split a vector that very many queries ask for.
    spread = settle(spread.withColumn("at", F.row_number().over(by_query)).filter(F.col("at") <= k + 1).drop("at"))
    answers = asking.select(F.col("id").alias("query_id"), "head").join(
        spread.withColumnRenamed("query", "head"), "head"
    ).filter("query_id <> id")
    ranked = Window.partitionBy("query_id").orderBy("score", "id")
    return (
        answers.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
