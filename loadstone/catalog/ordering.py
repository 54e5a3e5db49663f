"""Ordered operators (W*, O*, D12) on the test tables."""

from pyspark.sql import functions as F

from loadstone.catalog.registry import query
from loadstone.operators import sequences
from loadstone.session import settle

AS_OF = "2001-08-01 00:00:00"


def ratings(t):
    """Customers rated in the phase of their segment; rating and country from the balance and nation."""
    segment = {"AUTOMOBILE": 112, "BUILDING": 113, "FURNITURE": 117, "HOUSEHOLD": 118, "MACHINERY": 124}
    phase = F.lit(125)
    for name, value in segment.items():
        phase = F.when(F.col("c_mktsegment") == name, value).otherwise(phase)
    last = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_rated_project_id"))
    rated = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.floor(F.col("c_acctbal") / 10).alias("rating"), phase.cast("bigint").alias("phase_id"),
        (F.col("c_nationkey") % 12).cast("bigint").alias("school_id"),
        F.when(F.col("c_nationkey") > 2, F.col("c_nationkey").cast("string")).alias("country_code"),
    ).join(last, "user_id", "left")
    projects = t.orders.join(rated.select("user_id", "phase_id"), F.col("o_custkey") == F.col("user_id")).select(
        F.col("o_orderkey").alias("project_id"), "phase_id", F.col("o_orderdate").alias("posting_date")
    )
    active = sequences.active_users(rated, projects, AS_OF).withColumn("active", F.lit(1))
    flagged = rated.join(active, ["user_id", "phase_id"], "left").withColumn("active", F.coalesce("active", F.lit(0)))
    return settle(flagged.select("user_id", "rating", "phase_id", "school_id", "country_code", "active"))


_RATINGS = """
WITH last AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1),
r AS (
  SELECT c_custkey AS user_id, CAST(floor(c_acctbal / 10) AS BIGINT) AS rating,
         CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 112 WHEN 'BUILDING' THEN 113 WHEN 'FURNITURE' THEN 117 WHEN 'HOUSEHOLD' THEN 118
              WHEN 'MACHINERY' THEN 124 ELSE 125 END AS BIGINT) AS phase_id,
         CAST(c_nationkey % 12 AS BIGINT) AS school_id,
         CASE WHEN c_nationkey > 2 THEN CAST(c_nationkey AS VARCHAR) END AS country_code,
         CASE WHEN d > TIMESTAMP '2001-08-01' - INTERVAL 180 DAY THEN 1 ELSE 0 END AS active
  FROM customer LEFT JOIN last ON o_custkey = c_custkey),
typed AS (SELECT *, 1 AS user_rank_type_id FROM r UNION ALL SELECT *, 2 FROM r WHERE active = 1)
"""


def _ranks(keys: str, extra: str = "", where: str = "TRUE") -> str:
    window = f"(PARTITION BY {keys}, user_rank_type_id ORDER BY rating DESC"
    return _RATINGS + f"""
    SELECT {keys}, user_id, user_rank_type_id, rank() OVER {window}) AS rank{extra.format(w=window)},
           round(100 * ((count(*) OVER (PARTITION BY {keys}, user_rank_type_id) - rank() OVER {window}))::DOUBLE
                 / count(*) OVER (PARTITION BY {keys}, user_rank_type_id)), 4) AS percentile
    FROM typed WHERE {where}
    """


@query(_RATINGS + "SELECT user_id, phase_id, active FROM r")
def active_flag(t):
    """Users whose last rated project of the phase was posted in the last 180 days."""
    return ratings(t).select("user_id", "phase_id", "active")


@query(_ranks("phase_id"))
def rank_overall_active(t):
    """Rank with ties and percentile per phase, over all and over active users."""
    return sequences.rating_ranks(ratings(t), ["phase_id"]).select(
        "phase_id", "user_id", "user_rank_type_id", "rank", "percentile"
    )


_POSITION = ", row_number() OVER {w}, user_id) AS rank_no_tie"


@query(_ranks("phase_id, school_id", _POSITION, "school_id > 0"))
def rank_in_school(t):
    """Rank within the school; school 0 forms no group."""
    ranked = sequences.rating_ranks(ratings(t).filter("school_id > 0"), ["phase_id", "school_id"], position="rank_no_tie")
    return ranked.select("phase_id", "school_id", "user_id", "user_rank_type_id", "rank", "rank_no_tie", "percentile")


@query(_ranks("phase_id, country_code", _POSITION))
def rank_in_country(t):
    """Rank within the country; no country is a group too."""
    ranked = sequences.rating_ranks(ratings(t), ["phase_id", "country_code"], position="rank_no_tie")
    return ranked.select("phase_id", "country_code", "user_id", "user_rank_type_id", "rank", "rank_no_tie", "percentile")


_STREAK = """
WITH r AS (
  SELECT user_id, CASE WHEN event_type IN ('click', 'view') THEN 112 ELSE 113 END AS phase_id, event_id AS project_id,
         CASE WHEN value < 5 THEN 1 WHEN value < 12 THEN 2 WHEN value < 40 THEN 3 END AS placed,
         CASE WHEN event_type <> 'error' THEN CAST(round(value) AS BIGINT) END AS rating FROM events),
p AS (SELECT *, coalesce(placed, 0) AS pl, coalesce(rating, 0) AS ra,
             lag(coalesce(rating, 0)) OVER (PARTITION BY user_id, phase_id ORDER BY project_id) AS prev FROM r),
k AS (
  SELECT *, 1 AS kind, CASE WHEN pl = 1 THEN 1 ELSE 0 END AS ok FROM p UNION ALL
  SELECT *, 2, CASE WHEN pl IN (1, 2) THEN 1 ELSE 0 END FROM p UNION ALL
  SELECT *, 3, CASE WHEN prev >= 0 AND ra > prev THEN 1 ELSE 0 END FROM p UNION ALL
  SELECT *, 4, CASE WHEN prev >= 0 AND ra < prev THEN 1 ELSE 0 END FROM p),
i AS (SELECT *, sum(1 - ok) OVER (PARTITION BY kind, user_id, phase_id ORDER BY project_id) AS island,
             sum(1 - ok) OVER (PARTITION BY kind, user_id, phase_id) AS final FROM k)
SELECT user_id, phase_id, kind AS streak_type_id, min(project_id) AS start_project_id, max(project_id) AS end_project_id,
       count(*) AS length, max(CASE WHEN island = final THEN 1 ELSE 0 END) AS is_current
FROM i WHERE ok = 1 GROUP BY user_id, phase_id, kind, island HAVING count(*) > 1
"""


@query(_STREAK)
def streaks(t):
    """Runs of won, paid, rising and falling results per user and phase."""
    value, kind = F.col("value"), F.col("event_type")
    results = t.events.select(
        "user_id",
        F.when(kind.isin("click", "view"), 112).otherwise(113).alias("phase_id"),
        F.col("event_id").alias("project_id"), F.col("event_id").alias("rating_order"),
        F.when(value < 5, 1).when(value < 12, 2).when(value < 40, 3).alias("placed"),
        F.when(kind != "error", F.round("value").cast("bigint")).alias("rating"),
    )
    return sequences.streaks(results)


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS rated,
                  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS c, o_orderstatus FROM orders)
SELECT o_orderkey, o_custkey, CASE WHEN rated IS NULL THEN c ELSE CAST(sum(CASE WHEN rated IS NOT NULL THEN c ELSE 0 END)
       OVER (PARTITION BY o_custkey ORDER BY rated NULLS FIRST, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS num_ratings
FROM r
""")
def prior_count(t):
    """Finished orders of the customer up to this one; an undated row has no earlier ones."""
    rows = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("rated"),
    )
    return sequences.prior_count(
        rows, ["o_custkey"], ["rated", "o_orderkey"], F.col("o_orderstatus") == "F", "num_ratings"
    ).select("o_orderkey", "o_custkey", "num_ratings")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) - 1 AS sort
FROM lineitem
""")
def group_sequence(t):
    """0-based position in a group by several columns."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    return sequences.number_in_group(t.lineitem.select("l_orderkey", *order), ["l_orderkey"], order)


@query("""
SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS sort FROM events
""")
def response_sequence(t):
    """0-based position of a response among those of the same two keys."""
    return sequences.number_in_group(t.events.select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@query("""
WITH m AS (SELECT l_orderkey, l_suppkey, min(CASE WHEN l_linenumber <= 3 THEN l_linenumber ELSE 4 END) AS slot FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_suppkey, CAST(slot AS BIGINT) AS slot FROM m WHERE slot < 4
UNION ALL
SELECT l_orderkey, l_suppkey, 3 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) FROM m WHERE slot = 4
""")
def slot_assign(t):
    """Fixed slots stay, the others get 4, 5, ... per parent."""
    rows = t.lineitem.select(
        "l_orderkey", "l_suppkey", F.when(F.col("l_linenumber") <= 3, F.col("l_linenumber")).otherwise(4).alias("slot")
    )
    return sequences.assign_slots(rows, "l_orderkey", "l_suppkey", "slot")


@query("""
SELECT event_id, user_id, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY ts, event_id) AS points_id FROM events
""")
def surrogate_key(t):
    """Running ids above the highest one in use."""
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    return sequences.surrogate_keys(t.events.select("event_id", "user_id", "ts"), ["ts", "event_id"], "points_id", last).drop("ts")


@query("""
SELECT user_id, event_type, max(value) AS highest_rating, min(value) AS lowest_rating FROM events GROUP BY 1, 2
""")
def high_low(t):
    """Highest and lowest value ever per user and type."""
    return sequences.high_low(t.events, ["user_id", "event_type"], "value", "highest_rating", "lowest_rating")


@query("""
SELECT o_orderkey, l_linenumber AS place, prize, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber) AS expected_place,
       CASE WHEN l_linenumber <> row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber) THEN 1 ELSE 0 END AS gap
FROM (SELECT l_orderkey AS o_orderkey, l_linenumber, max(l_extendedprice) AS prize FROM lineitem GROUP BY 1, 2)
""")
def prize_list(t):
    """O2: prizes in order of place with a flag where a place is missing before."""
    prizes = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("place")).agg(
        F.max("l_extendedprice").alias("prize")
    )
    return sequences.place_gaps(prizes, ["o_orderkey"], "place")
