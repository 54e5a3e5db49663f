"""Quality rules: text statistics and robust multivariate outliers per language and source.

Statistics come from array functions over the whole text, without a shuffle. The
verdict is a minimum-covariance-determinant estimate per group: starting from
medians, each concentration step takes the half of a group's documents nearest to
the last estimate and estimates mean and covariance from them, so junk may be
almost half of a group.
Distances are counted in bins 4 % wide, so a step is one pass that sums moments per
group and bin, combined on the map side; the nearest bins that hold half
make the next estimate. No group is ever sorted or collected.

The estimate lives in SQL text that Spark and the check in ``sql`` both run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.session import settle

BLANK = "[ \\t-\\r]+"
STEPS = 10
# Documents a group needs for an estimate of its own; smaller ones are pooled.
LEAST = 50
# Robust standard deviations beyond which a document is rejected. Shares of repeated
# words have long tails in good text too; this leaves them alone.
CUTOFF = 10.0
# What a concentration step holds of a group. Junk beyond the rest would be forced into the estimate.
SHARE = 0.5
# Makes the covariance of the nearest half that of all, for five normal dimensions.
CONSISTENCY = 1.91
# Smallest spread of each dimension: a statistic that is nearly always zero still has a scale.
FLOORS = (0.25, 0.05, 0.05, 0.02, 0.05)
# Length comes first: it is conditioned on, never itself a reason.
VECTOR = {
    1: "ln(1 + CAST(n_words AS DOUBLE))",
    2: "ln(CAST(word_chars AS DOUBLE) / n_words)",
    3: "sqrt(CAST(n_symbols AS DOUBLE) / n_words)",
    4: "sqrt(CAST(n_dup_lines AS DOUBLE) / n_words)",
    5: "sqrt(CAST(n_repeat_words AS DOUBLE) / n_words)",
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
_DIMS = range(1, 6)
_PAIRS = [(i, j) for i in _DIMS for j in range(1, i + 1)]


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    words = (
        docs.withColumn("_text", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
        .withColumn("_words", F.array_remove(F.split("_text", BLANK), ""))
    )
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    windows = words.withColumn("_lines", lines).withColumn("_windows", F.expr(
        "sort_array(CASE WHEN size(_words) < 3 THEN CAST(array() AS array<struct<h: bigint, i: int>>) ELSE "
        "transform(sequence(0, size(_words) - 3), i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) AS h, i AS i)) END)"
    ))
    # Starts of windows found twice or more, in order of position.
    starts = windows.withColumn("_starts", F.expr(
        "array_sort(transform(filter(_windows, (x, k) -> (k > 0 AND get(_windows, k - 1).h = x.h) "
        "OR (k < size(_windows) - 1 AND get(_windows, k + 1).h = x.h)), x -> x.i))"
    ))
    covered = F.expr(
        "CASE WHEN size(_starts) = 0 THEN 0 ELSE 3 + aggregate(zip_with(slice(_starts, 2, size(_starts) - 1), "
        "slice(_starts, 1, size(_starts) - 1), (b, a) -> least(3, b - a)), 0, (x, y) -> x + y) END"
    )
    # Filters on the result stop at a number per row: pushed further down, they would split the text anew for every word.
    starts = starts.withColumn("_row", F.monotonically_increasing_id()).filter("_row >= 0")
    return starts.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("_text", "[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", F.expr(BASE_FAILED))


# --- the estimate as SQL -----------------------------------------------------------

GROUPS = f"""
WITH counts AS (
    SELECT lang, source, count(*) AS n FROM {{rows}} GROUP BY lang, source
), small AS (
    SELECT lang, sum(n) AS n FROM counts WHERE n < {LEAST} GROUP BY lang
)
SELECT c.lang, c.source, CASE
    WHEN c.n >= {LEAST} THEN concat('source ', c.lang, ' ', c.source)
    WHEN s.n >= {LEAST} THEN concat('lang ', c.lang) ELSE 'rest' END AS grp
FROM counts c LEFT JOIN small s ON c.lang = s.lang
"""

_LOWER = [(f"c{i}{j}", f"l{i}{j}") for i, j in _PAIRS]


def _factor() -> str:
    """Cholesky factor l of the covariance c; each column may use those before it."""
    parts = []
    for j in _DIMS:
        inner = "".join(f" - l{j}{k} * l{j}{k}" for k in range(1, j))
        parts.append(f"sqrt(c{j}{j}{inner}) AS l{j}{j}")
        for i in range(j + 1, 6):
            cross = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
            parts.append(f"(c{i}{j}{cross}) / l{j}{j} AS l{i}{j}")
    return ", ".join(parts)


_MEANS = ", ".join(f"m{i}" for i in _DIMS)
_CENTRE = ", ".join(f"{{median}}(floor(1000 * x{i}) / 1000, 0.5) AS m{i}" for i in _DIMS)
_SPREAD = ", ".join(
    f"pow(1.4826 * {{median}}(abs(floor(1000 * x{i}) / 1000 - m{i}), 0.5), 2) + {FLOORS[i - 1] ** 2!r} AS c{i}{i}" for i in _DIMS
)
CENTRE = f"SELECT grp, {_CENTRE} FROM {{rows}} GROUP BY grp"
START = f"""
SELECT grp, {_MEANS}, {', '.join(f'sqrt(c{i}{i}) AS l{i}{i}' for i in _DIMS)},
    {', '.join(f'CAST(0 AS DOUBLE) AS l{i}{j}' for i, j in _PAIRS if i != j)}
FROM (SELECT r.grp, {_SPREAD}, {', '.join(f'min(m{i}) AS m{i}' for i in _DIMS)}
    FROM {{rows}} r JOIN {{centre}} c ON r.grp = c.grp GROUP BY r.grp) spread
"""


def _distance() -> str:
    parts = []
    for i in _DIMS:
        before = "".join(f" - l{i}{k} * z{k}" for k in range(1, i))
        parts.append(f"(x{i} - m{i}{before}) / l{i}{i} AS z{i}")
    return ", ".join(parts)


_SQUARES = " + ".join(f"z{i} * z{i}" for i in _DIMS)
_SUMS = ", ".join([f"sum(x{i}) AS s{i}" for i in _DIMS] + [f"sum(x{i} * x{j}) AS s{i}{j}" for i, j in _PAIRS])
_TOTALS = ", ".join([f"sum(s{i}) / sum(n) AS m{i}" for i in _DIMS] + [f"sum(s{i}{j}) / sum(n) AS q{i}{j}" for i, j in _PAIRS])
_COVARIANCE = ", ".join(
    f"{CONSISTENCY} * (q{i}{j} - m{i} * m{j}){f' + {FLOORS[i - 1] ** 2!r}' if i == j else ''} AS c{i}{j}" for i, j in _PAIRS
)
# Moments per group and bin of distance.
BINS = f"""
SELECT grp, bin, count(*) AS n, {_SUMS} FROM (
    SELECT grp, {', '.join(f'x{i}' for i in _DIMS)}, CAST(floor(16 * log2({_SQUARES} + 1e-6)) AS INT) AS bin
    FROM (SELECT r.grp, {', '.join(f'x{i}' for i in _DIMS)}, {_distance()} FROM {{rows}} r JOIN {{estimate}} e ON r.grp = e.grp) placed
) scored GROUP BY grp, bin
"""
# The estimate from the nearest bins that hold the share.
NEXT = f"""
WITH ordered AS (
    SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY bin) - n AS before, sum(n) OVER (PARTITION BY grp) AS total FROM {{bins}}
), moments AS (
    SELECT grp, {_TOTALS} FROM ordered WHERE before < ceil({SHARE} * total) GROUP BY grp
)
SELECT grp, {_MEANS}, {', '.join(f'l{i}{j}' for i, j in _PAIRS)}
FROM (SELECT grp, {_MEANS}, {_COVARIANCE}, {_factor()} FROM moments) factored
"""
# What length explains is left out of the distance.
VERDICT = f"""
SELECT {{columns}}, sqrt({' + '.join(f'z{i} * z{i}' for i in _DIMS if i > 1)}) AS distance
FROM (SELECT r.*, {_distance()} FROM {{rows}} r JOIN {{estimate}} e ON r.grp = e.grp) placed
"""


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """One row per document: ``id_col``, ``text_hash``, the statistics, ``base_failed``, ``distance`` and ``kept``.

    ``kept`` is false if the base rules fail (fewer than 50 words, or more than half
    of them in repeated 3-word windows) or if the document lies more than
    ``CUTOFF`` robust standard deviations from its group, given its length. Groups are
    language and source; those of fewer than ``LEAST`` documents that pass the base
    rules are pooled by language, then all together; a pool that is still smaller
    gives no distance (null) and rejects nothing.

    Null or empty text: no words, base_failed. Null language or source counts as
    empty text. Null ids and repeated rows are judged like others. Other columns
    are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = statistics(docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("_body"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"),
    ), "_body").withColumn("text_hash", F.xxhash64("_body")).drop("_body")
    rows = settle(rows)
    passed = rows.filter("NOT base_failed").selectExpr("*", *[f"{text} AS x{i}" for i, text in VECTOR.items()])
    groups = spark.sql(GROUPS, rows=passed)
    vectors = settle(passed.join(groups, ["lang", "source"]))
    enough = vectors.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST).select("grp")
    # Settled in one file (a row per group), so that a small estimate is seen to be small and large groups are not moved to it.
    single = lambda frame: settle(frame.repartition(1))
    centre = single(spark.sql(CENTRE.replace("{median}", "percentile"), rows=vectors).join(enough, "grp"))
    estimate = single(spark.sql(START.replace("{median}", "percentile"), rows=vectors, centre=centre))
    for _ in range(STEPS):
        # Settled bins: else what all tasks hold of a group would meet in one task before it is summed up.
        bins = settle(spark.sql(BINS, rows=vectors, estimate=estimate))
        estimate = single(spark.sql(NEXT, bins=bins))
    columns = [id_col, "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    names = ", ".join(f"`{c}`" for c in columns)
    scored = spark.sql(VERDICT.replace("{columns}", names), rows=vectors, estimate=estimate)
    unscored = vectors.join(estimate.select("grp"), "grp", "left_anti").unionByName(
        rows.filter("base_failed"), allowMissingColumns=True
    ).select(*columns, F.lit(None).cast("double").alias("distance"))
    verdict = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return scored.unionByName(unscored).withColumn("kept", verdict)


def keep_documents(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    rejected = judge(docs, **columns).filter("NOT kept").select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs[id_col].eqNullSafe(rejected["_id"]) & (F.xxhash64(docs[text_col].cast("string")) == rejected["_hash"])
    return docs.join(rejected, same, "left_anti")
