"""Aggregates (D*), ledgers and scoring (U*) on the test tables."""

from pyspark.sql import functions as F

from loadstone.catalog.registry import query
from loadstone.operators import aggregates, joins, scoring

money = lambda column: F.col(column).cast("decimal(18,2)")


@query("""
SELECT c_custkey, count(o_orderkey) AS num_orders,
       count(CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 END) AS num_valid,
       count(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1 END) AS num_pending_urgent
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate > TIMESTAMP '2000-01-01' GROUP BY 1
""")
def child_counts(t):
    """Children of a parent counted by several conditions in one pass."""
    status = F.col("o_orderstatus")
    late = t.orders.filter(F.col("o_orderdate") > F.lit("2000-01-01").cast("timestamp_ntz"))
    names = ["num_orders", "num_valid", "num_pending_urgent"]
    return aggregates.with_child_values(
        t.customer.select("c_custkey"), late, "c_custkey",
        {
            "num_orders": F.count(F.lit(1)),
            "num_valid": aggregates.count_where(status.isin("F", "O")),
            "num_pending_urgent": aggregates.count_where((status == "P") & (F.col("o_orderpriority") == "1-URGENT")),
        },
        zero=names, child_key="o_custkey",
    )


@query("""
SELECT o_orderkey,
       CAST(sum(CASE WHEN l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS first_place_prize,
       CAST(coalesce(sum(CASE WHEN l_returnflag IN ('A', 'R') THEN CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS total_prize,
       max(CASE WHEN l_returnflag = 'N' THEN l_shipdate END) AS last_new, min(l_shipdate) AS first_ship,
       round(avg(CASE WHEN l_discount > 0.02 THEN CAST(l_quantity AS DECIMAL(18,2)) END), 6) AS avg_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def child_sums(t):
    """Sums, extremes, averages and weighted sums per parent."""
    sums = aggregates.with_child_values(
        t.orders.select("o_orderkey"), t.lineitem, "o_orderkey",
        {
            "first_place_prize": F.sum(F.when(F.col("l_linenumber") == 1, money("l_extendedprice"))),
            "total_prize": F.sum(F.when(F.col("l_returnflag").isin("A", "R"), money("l_quantity") * money("l_tax"))),
            "last_new": F.max(F.when(F.col("l_returnflag") == "N", F.col("l_shipdate"))),
            "first_ship": F.min("l_shipdate"),
            "avg_quantity": F.avg(F.when(F.col("l_discount") > 0.02, F.col("l_quantity"))),
        },
        zero=["total_prize"], child_key="l_orderkey",
    )
    return sums.select(
        "o_orderkey", F.col("first_place_prize").cast("double").alias("first_place_prize"),
        F.col("total_prize").cast("double").alias("total_prize"), "last_new", "first_ship",
        F.round("avg_quantity", 6).alias("avg_quantity"),
    )


@query("""
WITH counted AS (
  SELECT o_orderkey AS id, o_custkey AS project, o_orderkey % 700 AS parent, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS kind,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status FROM orders),
own AS (SELECT CASE WHEN project % 3 <> 0 THEN project END AS project, kind, amount FROM counted WHERE status <> 'P'),
below AS (SELECT CASE WHEN p.project % 3 <> 0 THEN p.project END AS project, c.kind, c.amount
          FROM counted c JOIN counted p ON c.parent = p.id WHERE c.status <> 'P')
SELECT project AS project_id, CAST(sum(amount) AS DOUBLE) AS all_cost,
       CAST(coalesce(sum(CASE WHEN kind = 1 THEN amount END), 0) AS DOUBLE) AS urgent_cost,
       CAST(coalesce(sum(CASE WHEN kind IN (2, 3) THEN amount END), 0) AS DOUBLE) AS middle_cost
FROM (SELECT * FROM own UNION ALL SELECT * FROM below) WHERE project IS NOT NULL GROUP BY 1
""")
def parent_child_sum(t):
    """Cost columns from own and child payments in one grouped pass."""
    payments = t.orders.select(F.col("o_orderkey").alias("payment_id"), F.col("o_orderkey").alias("most_recent_detail_id"))
    details = t.orders.select(
        F.col("o_orderkey").alias("payment_detail_id"),
        (F.col("o_orderkey") % 700).alias("parent_payment_id"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("component_project_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type_id"),
        F.when(F.col("o_orderstatus") == "P", 65).otherwise(53).alias("payment_status_id"),
        F.lit(1).alias("installment_number"),
        money("o_totalprice").alias("total_amount"),
    )
    costs = aggregates.payment_costs(payments, details, {"all_cost": None, "urgent_cost": [1], "middle_cost": [2, 3]})
    return costs.select("project_id", *[F.col(c).cast("double").alias(c) for c in ("all_cost", "urgent_cost", "middle_cost")])


@query("""
SELECT o_custkey AS direct_project_id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS project_category_id,
       CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS stat_date,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) + 10) AS DOUBLE) AS cost,
       CAST(sum(date_diff('minute', TIMESTAMP '1994-12-31 12:00:00', o_orderdate)) AS BIGINT) AS duration,
       count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS fulfillment, count(*) AS total_project
FROM orders WHERE o_custkey > 0 GROUP BY 1, 2, 3
""")
def group_stats_by_day(t):
    """Cost, minutes, completed and total per project, category and day."""
    status = F.col("o_orderstatus")
    projects = t.orders.select(
        F.col("o_custkey").alias("tc_direct_project_id"),
        F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("project_category_id"),
        F.col("o_orderdate").alias("complete_date"),
        F.lit("1994-12-31 12:00:00").cast("timestamp_ntz").alias("posting_date"),
        F.lit(10).alias("admin_fee"), F.col("o_totalprice").alias("contest_prizes_total"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 7).otherwise(1).alias("status_id"),
    )
    return aggregates.daily_stats(projects).withColumn("cost", F.col("cost").cast("double"))


@query("""
SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS day, o_orderpriority,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, min(o_custkey) AS first_customer, count(*) AS orders
FROM orders GROUP BY 1, 2
""")
def group_sums(t):
    """Sums and minima per group."""
    return t.orders.groupBy(F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("day"), "o_orderpriority").agg(
        F.sum(money("o_totalprice")).cast("double").alias("total"),
        F.min("o_custkey").alias("first_customer"),
        F.count(F.lit(1)).alias("orders"),
    )


@query("""
SELECT l_orderkey, count(*) AS num_appeals,
       CASE WHEN count(CASE WHEN l_returnflag <> 'N' THEN 1 END) > 0 THEN count(CASE WHEN l_returnflag = 'R' THEN 1 END) END AS num_successful_appeals
FROM lineitem GROUP BY 1
""")
def tri_state_count(t):
    """Null where nothing was decided, else the number of successes."""
    extra = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("num_appeals"),
        aggregates.tri_state_count(extra.isNotNull(), extra == "R").alias("num_successful_appeals"),
    )


@query("""
WITH lim AS (SELECT l_orderkey, min(l_shipdate) AS lim FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT l.l_orderkey, max(CASE WHEN l_shipdate <= lim THEN l_shipdate END) AS last_before
FROM lineitem l JOIN lim ON lim.l_orderkey = l.l_orderkey WHERE l_returnflag = 'N' GROUP BY 1
""")
def cutoff_max(t):
    """The last end of one kind that is not after the first start of another."""
    return aggregates.cutoff_max(
        t.lineitem, "l_orderkey", F.col("l_shipdate"), F.col("l_returnflag") == "N",
        F.col("l_shipdate"), F.col("l_returnflag") == "A", "last_before",
    )


@query("""
SELECT o_custkey, max(l_shipdate) AS last_ship, max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS last_return
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1
""")
def joined_group_max(t):
    """Latest dates per group of a filtered join."""
    rows = t.lineitem.join(t.orders.filter(F.col("o_orderstatus") != "P"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("o_custkey").agg(
        F.max("l_shipdate").alias("last_ship"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("last_return"),
    )


def event_points(t):
    kind = F.col("event_type")
    return t.events.select(
        "user_id", money("value").alias("amount"), (kind == "view").alias("is_potential"), (kind == "purchase").alias("taxable"),
        F.when(kind == "click", F.floor("value") % 7).otherwise(0).cast("bigint").alias("placed"),
        money("value").alias("final_score"),
    )


@query("""
WITH p AS (SELECT user_id, CAST(value AS DECIMAL(18,2)) AS amount, event_type AS k,
                  CAST(CASE WHEN event_type = 'click' THEN floor(value) % 7 ELSE 0 END AS BIGINT) AS placed FROM events)
SELECT user_id, CAST(coalesce(sum(CASE WHEN k <> 'view' THEN amount END), 0) AS DOUBLE) AS initial_points,
       CAST(coalesce(sum(CASE WHEN k <> 'view' THEN amount END), 0) AS DOUBLE) AS final_points,
       CAST(coalesce(sum(CASE WHEN k = 'purchase' THEN amount END), 0) AS DOUBLE) AS taxable_points,
       CAST(coalesce(sum(CASE WHEN k = 'view' THEN amount END), 0) AS DOUBLE) AS potential_points,
       count(CASE WHEN placed > 0 THEN 1 END) AS placed_results,
       min(CASE WHEN placed > 0 THEN placed END) AS best_place,
       CAST(max(CASE WHEN placed > 0 THEN amount END) AS DOUBLE) AS best_score
FROM p GROUP BY 1
""")
def points_ledger(t):
    """Awarded, taxable and potential points per user."""
    ledger = aggregates.points_ledger(event_points(t), ["user_id"])
    return ledger.withColumns({
        c: F.col(c).cast("double")
        for c in ("initial_points", "final_points", "taxable_points", "potential_points", "best_score")
    })


def contest_results(t):
    """Customers' orders as results of a contest per nation."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(
        F.col("c_nationkey").cast("bigint").alias("contest_id"), F.col("c_custkey").alias("user_id"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 7).when(F.col("o_orderstatus") == "O", 8).otherwise(1).alias("project_status_id"),
        F.lit(1).alias("valid_submission_ind"), (F.col("o_orderkey") % 3 - 1).alias("point_adjustment"),
        money("o_totalprice").alias("amount"), (F.col("o_orderkey") % 6).cast("int").alias("placed"),
        F.lit(4).alias("num_submissions_passed_review"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "winner_takes_all").alias("calculator"),
    )


_RESULTS_SQL = """
WITH r AS (
  SELECT CAST(c_nationkey AS BIGINT) AS contest_id, c_custkey AS user_id, o_orderkey, o_orderstatus AS st, o_orderkey % 3 - 1 AS adj,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, CAST(o_orderkey % 6 AS INTEGER) AS placed, o_orderpriority = '1-URGENT' AS winner
  FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (
  SELECT *, CASE WHEN st = 'P' THEN 0 WHEN winner THEN CASE WHEN placed = 1 THEN amount ELSE 0 END
                 ELSE floor(amount * (CASE placed WHEN 1 THEN 0.6::DOUBLE WHEN 2 THEN 0.22::DOUBLE WHEN 3 THEN 0.1::DOUBLE WHEN 4 THEN 0.08::DOUBLE ELSE 0 END) * 100.0 + 0.5) / 100.0 END AS points_awarded,
         CASE WHEN st <> 'P' THEN 0 WHEN winner THEN amount ELSE floor(amount * 0.6::DOUBLE * 100.0 + 0.5) / 100.0 END AS potential_points
  FROM r)
"""


@query(_RESULTS_SQL + """
SELECT contest_id, user_id, o_orderkey, points_awarded, points_awarded + adj AS final_points, potential_points FROM s
""")
def score_results(t):
    """Awarded and potential points by the calculator a row names."""
    return scoring.score_results(contest_results(t)).select(
        "contest_id", "user_id", "o_orderkey", "points_awarded", "final_points", "potential_points"
    )


@query(_RESULTS_SQL + """
, f AS (SELECT contest_id, user_id, 'points' AS how,
          sum(CAST(points_awarded AS DECIMAL(18,2))) AS initial_points, sum(CAST(points_awarded + adj AS DECIMAL(18,2))) AS final_points,
          sum(CAST(potential_points AS DECIMAL(18,2))) AS potential_points FROM s GROUP BY 1, 2
        UNION ALL
        SELECT contest_id, user_id, 'top_performers',
          sum(CAST(points_awarded * w AS DECIMAL(18,2))), sum(CAST((points_awarded + adj) * w AS DECIMAL(18,2))),
          sum(CAST(potential_points * w AS DECIMAL(18,2)))
        FROM (SELECT *, CASE WHEN placed = 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s) GROUP BY 1, 2),
k AS (SELECT *, rank() OVER (PARTITION BY how, contest_id ORDER BY final_points DESC) AS place FROM f),
prizes AS (SELECT CAST(s_nationkey AS BIGINT) AS contest_id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS place, s_acctbal AS prize FROM supplier)
SELECT how, k.contest_id, user_id, CAST(initial_points AS DOUBLE) AS initial_points, CAST(final_points AS DOUBLE) AS final_points,
       CAST(potential_points AS DOUBLE) AS potential_points, k.place AS current_place, CASE WHEN final_points > 0 THEN prize END AS current_prize
FROM k LEFT JOIN prizes p ON p.contest_id = k.contest_id AND p.place = k.place
""")
def contest_score(t):
    """Place, points and prize per contest and user, for both rankings."""
    from loadstone.operators.sequences import scan

    prizes = scan(
        t.supplier.select(F.col("s_nationkey").cast("bigint").alias("contest_id"), "s_acctbal", "s_suppkey"),
        ["contest_id"], [F.col("s_acctbal").desc(), "s_suppkey"], number="place",
    ).withColumnRenamed("s_acctbal", "prize_amount")
    results = scoring.score_results(contest_results(t))
    parts = [
        scoring.rank_contests(results, prizes, how, factor).select(
            F.lit(how).alias("how"), "contest_id", "user_id",
            *[F.col(c).cast("double").alias(c) for c in ("initial_points", "final_points", "potential_points")],
            "current_place", "current_prize",
        )
        for how, factor in (("points", 1.0), ("top_performers", 2.0))
    ]
    return parts[0].unionByName(parts[1])


@query("""
WITH a AS (SELECT o_custkey AS user_id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS day, 1 AS kind FROM orders
           UNION SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP), CASE WHEN event_type IN ('click', 'view') THEN 3 ELSE 4 END FROM events)
SELECT user_id, day, kind, c_mktsegment FROM a JOIN customer ON c_custkey = user_id
""")
def activity_union(t):
    """Distinct activities of several kinds, joined to a warehouse table."""
    day = lambda c: F.date_trunc("day", c).cast("timestamp_ntz").alias("day")
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), day("o_orderdate"), F.lit(1).alias("kind"))
    events = t.events.select("user_id", day("ts"), F.when(F.col("event_type").isin("click", "view"), 3).otherwise(4).alias("kind"))
    found = joins.lookup(
        orders.unionByName(events).distinct(), t.customer, {"user_id": "c_custkey"}, {"c_mktsegment": "c_mktsegment"}
    )
    return found.select("user_id", "day", "kind", "c_mktsegment")
