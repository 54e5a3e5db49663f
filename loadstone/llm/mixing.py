"""Mixing of sources to target weights by iterative proportional fitting, then calibrated sampling.

Documents are summed up to cells of source, language and topic. The token weights of the
cells are raked: scaled to each marginal's targets in turn, again and again, and
never above the tokens a cell has, so that no document is asked for more than once. A
document is kept with the probability of its cell (weight / tokens), decided by a
hash of its id, so the same documents are kept on every run and on every machine.

Only cells are iterated over, in SQL text that Spark and the check in ``sql`` both run, a round (all
marginals in turn) at a time, until a round changes nothing any more. Cell sums are grouped
sums, combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loadstone.session import settle

MARGINS = ("source", "lang", "topic")
# Rounds at most, and the change of a cell, as a share of its tokens, below which raking has settled.
ROUNDS = 8
SETTLED = 1e-9
# Exponent that evens out natural shares to targets: 1 leaves them, 0 makes all equal.
EVENNESS = 0.7
# Tokens to keep, as a share of all tokens.
BUDGET = 0.85
TOPICS = 8
# Letters of the words that stand for a topic.
TOPIC_LETTERS = 6
BLANK = "[ \\t-\\r]+"

CELLS = "SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS have FROM {rows} GROUP BY source, lang, topic"
# A target is a share of the budget; marginals have equal sums by construction.
TARGETS = f"""
SELECT {{margin}} AS value, pow(sum(have), {EVENNESS}) * {{budget}}
    * (SELECT sum(have) FROM {{cells}})
    / (SELECT sum(share) FROM (SELECT pow(sum(have), {EVENNESS}) AS share FROM {{cells}} GROUP BY {{margin}}) shares) AS target
FROM {{cells}} GROUP BY {{margin}}
"""
SCALE = """
SELECT c.source, c.lang, c.topic, c.have{more}, CASE WHEN c.now > 0 THEN least(c.have, c.weight * t.target / c.now) ELSE 0 END AS weight
FROM (SELECT *, sum(weight) OVER (PARTITION BY {margin}) AS now FROM {cells}) c JOIN {targets} t ON c.{margin} = t.value
"""
# 52 bits of a hash of the id, as a share of 2^52.
CHANCE = "CAST(conv(substr(md5(concat('{seed}:', {id})), 1, 13), 16, 10) AS DOUBLE) / 4503599627370496D"
SEED = 11


def _with_topic(rows: DataFrame, topics: int = TOPICS) -> DataFrame:
    """``rows`` with ``tokens`` (words of column ``text``) and ``topic``.

    The tables carry no topics, so a stand-in is used that SQL can express: the hash class of the word
    of at least ``TOPIC_LETTERS`` characters that the whole text has most often (of equals the first in
    byte order). ``mix`` takes a column of real topics in its place.
    """
    words = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), BLANK), "")
    # Each step is kept apart by a number per row: merged into one, they would split the text anew for every word.
    step = lambda frame: frame.withColumn("step", F.monotonically_increasing_id()).filter("step >= 0").drop("step")
    rows = step(rows.withColumn("words", words))
    rows = step(rows.select(
        "*", F.size("words").cast("long").alias("tokens"), F.sort_array(F.filter("words", lambda w: F.char_length(w) >= TOPIC_LETTERS)).alias("long")
    ).drop("words"))
    begins = F.expr("CASE WHEN size(long) > 0 THEN filter(sequence(0, size(long) - 1), i -> i = 0 OR long[i] <> long[i - 1]) END")
    rows = step(rows.withColumn("begins", begins))
    most = F.expr("array_min(transform(begins, (i, k) -> struct(i - coalesce(get(begins, k + 1), size(long)) AS fewer, long[i] AS word))).word")
    topic = F.conv(F.substring(F.md5(F.coalesce(most, F.lit(""))), 1, 8), 16, 10).cast("long") % topics
    return rows.withColumn("topic", F.concat(F.lit("topic"), topic.cast("string"))).drop("long", "begins")


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells (source, lang, topic, have) with ``weight``, raked to the targets (value, target) of each marginal.

    Ends after ``rounds`` rounds, or as soon as a round moves no cell by more than ``SETTLED`` of its tokens.
    Targets of a value without cells cannot be met and are left out; a value without
    a target gets weight 0. Where cells are full, the other cells of the marginal
    take what they can, so totals may stay below the targets; ``misses`` tells by how much.
    """
    spark = cells.sparkSession
    cells = settle(cells.withColumn("weight", F.col("have")))
    fixed = {}
    for margin, given in targets.items():
        known = given.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), "target")
        values = cells.select(F.col(margin).alias("value")).distinct().join(known, "value", "left")
        fixed[margin] = settle(values.select("value", F.coalesce(F.col("target").cast("double"), F.lit(0.0)).alias("target")))
    for _ in range(rounds):
        step, seen = cells.withColumn("before", F.col("weight")), Observation()
        for margin in MARGINS:
            step = spark.sql(SCALE.replace("{margin}", margin).replace("{more}", ", c.before"), cells=step, targets=fixed[margin])
        # How far the round moved a cell is seen while it is written; an extra job would double the plans the driver keeps.
        change = F.max(F.abs(F.col("weight") - F.col("before")) / F.greatest("have", F.lit(1.0))).alias("moved")
        cells = settle(step.observe(seen, change).drop("before"))
        moved = seen.get["moved"]
        if moved is None or moved <= SETTLED:
            break
    return cells


def misses(raked: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(margin, value, target, weight): what raking gave each value that has cells; null target where none was given."""
    parts = []
    for margin in MARGINS:
        sums = raked.groupBy(F.col(margin).alias("value")).agg(F.sum("weight").alias("weight"))
        given = targets[margin].select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), F.col("target").cast("double").alias("target"))
        parts.append(sums.join(given, "value", "left").select(F.lit(margin).alias("margin"), "value", "target", "weight"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def natural_targets(cells: DataFrame, budget: float = BUDGET) -> dict[str, DataFrame]:
    """Targets of each marginal: natural token shares to the power of ``EVENNESS``, as shares of the budget."""
    spark = cells.sparkSession
    return {
        m: spark.sql(TARGETS.replace("{margin}", m).replace("{budget}", repr(budget)), cells=cells) for m in MARGINS
    }


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: dict[str, DataFrame] | None = None,
    budget: float = BUDGET, seed: int = SEED, rounds: int = ROUNDS, topic_col: str | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``tokens``, ``topic``, ``probability`` and ``sampled``.

    ``targets`` maps "source", "lang" and "topic" to frames (value, target tokens); by default
    they are the natural shares evened out (see ``natural_targets``). Documents of a value
    without a target stay in the result with probability 0. ``topic_col`` names a column of
    topics, which is ``topic`` in the result as it is; without it a stand-in is derived from the text.

    Null source, language or topic is a value of its own, written as '' in targets; null or empty text has no
    tokens. A cell without tokens has probability 1: such documents change no total.
    A null id is sampled as the id ''. Repeated rows are sampled alike. Columns called
    like the new ones are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    new = ("tokens", "topic", "probability", "sampled")
    clean = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    # The caller's columns travel in one struct, so no name of theirs can meet one of these.
    rows = _with_topic(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in new]).alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"),
        clean("source").alias("source"), clean("lang").alias("lang"), clean(id_col).alias("id"),
        *([F.col(f"`{topic_col}`").alias("given")] if topic_col else []),
    )).drop("text")
    if topic_col:
        rows = rows.withColumn("topic", F.col("given")).drop("given")
    rows = rows.withColumn("cell_topic", F.coalesce(F.col("topic").cast("string"), F.lit("")))
    cells = settle(spark.sql(CELLS, rows=rows.select("source", "lang", F.col("cell_topic").alias("topic"), "tokens")))
    raked = rake(cells, targets or natural_targets(cells, budget), rounds)
    chances = raked.select(
        "source", "lang", F.col("topic").alias("cell_topic"),
        F.when(F.col("have") > 0, F.col("weight") / F.col("have")).otherwise(1.0).alias("probability"),
    )
    drawn = F.expr(CHANCE.format(seed=seed, id="id"))
    return rows.join(chances, ["source", "lang", "cell_topic"]).select(
        "doc.*", "tokens", "topic", "probability", (drawn < F.col("probability")).alias("sampled")
    )
