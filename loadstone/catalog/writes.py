"""Write modes (A11-A25) on the test tables.

The old target of an upsert is the state of an earlier day: the rows up to a
date, with a column that differs from the source where it has to be overwritten.
"""

from pyspark.sql import functions as F

from loadstone.catalog.registry import query
from loadstone.operators import merge
from loadstone.operators.joins import calendar_lookup
from loadstone.session import scratch_path
from loadstone.sources import Warehouse

_EARLY = "TIMESTAMP '1997-01-01'"
_LATE = "TIMESTAMP '1999-06-01'"


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def old_orders(t):
    return t.orders.filter(F.col("o_orderdate") <= stamp("1999-06-01")).select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), F.lit("old").alias("state")
    )


def new_orders(t):
    return t.orders.filter(F.col("o_orderdate") > stamp("1997-01-01")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.lit("new").alias("state")
    )


_UPSERT_ORDERS = f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate > {_EARLY} THEN o_orderstatus ELSE 'X' END AS o_orderstatus,
       CASE WHEN o_orderdate > {_EARLY} THEN 'new' ELSE 'old' END AS state
FROM orders
"""


@query(_UPSERT_ORDERS)
def upsert_single(t):
    """Update or insert by one key."""
    return merge.upsert(old_orders(t), new_orders(t), ["o_orderkey"])


@query(_UPSERT_ORDERS)
def upsert_checked(t):
    """As above, failing if a key is not unique in the target or in the changes."""
    keys = ["o_orderkey"]
    return merge.upsert(merge.assert_unique(old_orders(t), keys), merge.assert_unique(new_orders(t), keys), keys)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, 'new' AS state FROM orders
""")
def upsert_full_refresh(t):
    """All source rows, no mark; every row is replaced or inserted."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.lit("new").alias("state"))
    return merge.upsert(old_orders(t), rows, ["o_orderkey"])


LINE = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]


@query("""
WITH ranked AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
         l_shipdate > TIMESTAMP '1997-01-01' AS is_new,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate > TIMESTAMP '1997-01-01'
                            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n,
         bool_or(l_shipdate > TIMESTAMP '1997-01-01') OVER (PARTITION BY l_orderkey, l_linenumber) AS any_new
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity
FROM ranked WHERE n = 1 AND (is_new OR NOT any_new)
""")
def upsert_composite(t):
    """By two keys; the last of several changes of a key wins."""
    lines = t.lineitem.select(*LINE)
    keys, order = LINE[:2], LINE[2:]
    target = merge.last_per_key(lines.filter(F.col("l_shipdate") <= stamp("1997-01-01")), keys, order)
    return merge.upsert(target, lines.filter(F.col("l_shipdate") > stamp("1997-01-01")), keys, order)


@query(f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate > {_EARLY} THEN o_orderstatus ELSE 'X' END AS o_orderstatus,
       CASE WHEN o_orderdate > {_LATE} THEN 'new' ELSE 'old' END AS state
FROM orders
""")
def upsert_partial(t):
    """A match updates the status only, a miss inserts the whole row."""
    return merge.upsert(old_orders(t), new_orders(t), ["o_orderkey"], update=["o_orderstatus"])


@query(f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate > {_EARLY} AND c_acctbal > 0 AND c_mktsegment = 'BUILDING' THEN o_orderstatus ELSE 'X' END AS o_orderstatus,
       CASE WHEN o_orderdate > {_EARLY} AND c_acctbal > 0 AND c_mktsegment = 'BUILDING' THEN 'new' ELSE 'old' END AS state
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate <= {_LATE} OR (c_acctbal > 0 AND c_mktsegment = 'BUILDING')
""")
def upsert_guarded(t):
    """Changes whose customer is not in the warehouse are left out."""
    parents = t.customer.filter((F.col("c_acctbal") > 0) & (F.col("c_mktsegment") == "BUILDING"))
    return merge.upsert_guarded(
        old_orders(t), new_orders(t), ["o_orderkey"], parents.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]
    )


_LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate"


@query(f"""
WITH touched AS (SELECT o_orderkey FROM orders WHERE o_orderdate > {_LATE})
SELECT {_LINES}, 'old' AS state FROM lineitem
WHERE l_shipdate <= {_LATE} AND l_orderkey NOT IN (SELECT o_orderkey FROM touched)
UNION ALL
SELECT {_LINES}, 'new' FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM touched)
""")
def replace_by_key(t):
    """The lines of touched orders are dropped and written again."""
    names = [c.strip() for c in _LINES.split(",")]
    target = t.lineitem.filter(F.col("l_shipdate") <= stamp("1999-06-01")).select(*names, F.lit("old").alias("state"))
    touched = t.orders.filter(F.col("o_orderdate") > stamp("1999-06-01")).select(F.col("o_orderkey").alias("l_orderkey"))
    fresh = t.lineitem.join(touched, "l_orderkey", "left_semi").select(*names, F.lit("new").alias("state"))
    return merge.replace_by_key(target, fresh, ["l_orderkey"], touched)


@query(f"""
WITH fresh AS (SELECT {_LINES} FROM lineitem WHERE l_shipdate > TIMESTAMP '2000-06-01')
SELECT {_LINES}, 'old' AS state FROM lineitem
WHERE l_shipdate <= TIMESTAMP '2000-06-01' AND l_orderkey NOT IN (SELECT l_orderkey FROM fresh)
UNION ALL
SELECT {_LINES}, 'new' FROM fresh
""")
def replace_children(t):
    """Only parents with new rows lose their old ones; a first run would append."""
    names = [c.strip() for c in _LINES.split(",")]
    target = t.lineitem.filter(F.col("l_shipdate") <= stamp("2000-06-01")).select(*names, F.lit("old").alias("state"))
    fresh = t.lineitem.filter(F.col("l_shipdate") > stamp("2000-06-01")).select(*names, F.lit("new").alias("state"))
    return merge.replace_by_key(target, fresh, ["l_orderkey"])


@query("""
SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-10'
GROUP BY ALL
EXCEPT
SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP), event_type FROM events WHERE ts <= TIMESTAMP '2024-01-20'
""")
def append_only(t):
    """Rows to append; those an earlier run with the same mark appended are left out."""
    days = t.events.select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type", "ts")
    target = days.filter(F.col("ts") <= stamp("2024-01-20")).drop("ts").distinct()
    rows = days.filter(F.col("ts") > stamp("2024-01-10")).drop("ts")
    return merge.append_new(target, rows, ["user_id", "day", "event_type"])


@query("""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events GROUP BY ALL
""")
def reload_table(t):
    """The whole table computed anew (the write replaces the old version)."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    return t.events.groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, 'old' AS state FROM orders
WHERE o_orderdate <= {_LATE} AND o_orderstatus <> 'F'
""")
def delete_by_status(t):
    """Rows whose source row is now in a deleted state go."""
    gone = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    return merge.delete_keys(old_orders(t), gone, "o_orderkey")


@query("""
WITH gone AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
SELECT 'orders' AS table_name, o_orderkey AS id, CAST(1 AS BIGINT) AS rows FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)
UNION ALL
SELECT 'lineitem', l_orderkey, count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone) AND l_partkey NOT IN (SELECT o_orderkey FROM gone) GROUP BY 2
UNION ALL
SELECT 'part', p_partkey, 1 FROM part
""")
def cascade_delete(t):
    """Deleted keys go from every dependent table, in one of them by two columns."""
    gone = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey")
    rules = [("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("orders", "o_orderkey")]
    left = merge.cascade_delete({"orders": t.orders, "lineitem": t.lineitem, "part": t.part}, rules, gone)
    parts = [
        left[table].groupBy(F.lit(table).alias("table_name"), F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("rows"))
        for table, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("part", "p_partkey"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
SELECT o_orderkey, o_custkey, CAST(q AS DOUBLE) AS total_quantity, n AS line_count
FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, count(*) AS n FROM lineitem GROUP BY 1)
ON o_orderkey = l_orderkey
""")
def backfill_columns(t):
    """New columns of all rows, as none has a value yet."""
    target = t.orders.select(
        "o_orderkey", "o_custkey",
        F.lit(None).cast("double").alias("total_quantity"), F.lit(None).cast("bigint").alias("line_count"),
    )
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("total_quantity"), F.count(F.lit(1)).alias("line_count")
    )
    return merge.backfill(target, lines, ["o_orderkey"], ["total_quantity", "line_count"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END END AS fulfillment,
       CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) END AS start_date_calendar_id
FROM orders
""")
def post_update(t):
    """Columns derived on the whole target, set only where the condition holds."""
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct().select(
        F.datediff("day", F.lit("1990-01-01").cast("date")).cast("bigint").alias("calendar_id"),
        F.year("day").alias("year"), F.month("day").alias("month_numeric"), F.dayofmonth("day").alias("day_of_month"),
    )
    target = calendar_lookup(t.orders, days, {"found": "o_orderdate"})
    done = merge.set_where(
        target,
        F.col("o_orderdate") > stamp("1998-01-01"),
        fulfillment=F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        start_date_calendar_id=F.col("found"),
    )
    return done.select("o_orderkey", "fulfillment", "start_date_calendar_id")


@query("""
SELECT o_orderkey, o_custkey, CAST(a AS BIGINT) AS num_returned, CAST(b AS BIGINT) AS num_big
FROM orders LEFT JOIN (
  SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) AS b
  FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
""")
def back_annotate(t):
    """Sums over one warehouse table written back to another."""
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("num_returned"),
        F.sum(F.when(F.col("l_quantity") > 40, 1).otherwise(0)).alias("num_big"),
    )
    return merge.annotate(t.orders.select("o_orderkey", "o_custkey"), sums, ["o_orderkey"], ["num_returned", "num_big"])


@query("""
SELECT * EXCLUDE (n) FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n
  FROM lineitem) WHERE n = 1
""")
def last_row_wins(t):
    """One row per key, the last by an explicit order."""
    return merge.last_per_key(t.lineitem.select(*LINE), LINE[:2], LINE[2:])


@query(f"""
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, CASE WHEN o_orderdate > {_LATE} THEN 'late' ELSE 'early' END AS state FROM orders
UNION ALL SELECT -o_orderkey, CAST(0 AS DOUBLE), 'added' FROM orders WHERE o_orderstatus = 'P'
""")
def warehouse_writes(t):
    """A table written whole, merged into the buckets that changed, appended to, and read back."""
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"), "o_orderdate", "o_orderstatus")
    late = F.col("o_orderdate") > F.expr(_LATE)
    house = Warehouse(t._spark, scratch_path(t._spark, "warehouse"), buckets={"prices": (["o_orderkey"], 16)})
    house.write("prices", rows.filter(~late).select("o_orderkey", "price", F.lit("early").alias("state")))
    fresh = rows.filter(late).select("o_orderkey", "price", F.lit("late").alias("state"))
    house.write("prices", merge.upsert(house.near("prices", fresh), fresh, ["o_orderkey"]), touched=fresh.select("o_orderkey"))
    added = rows.filter("o_orderstatus = 'P'").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit(0.0).alias("price"), F.lit("added").alias("state"))
    house.write("prices", added, "append")
    return house.table("prices")
