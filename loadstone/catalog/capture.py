"""Change capture, sources and reports (S*, A1-A10, A26) on the test tables."""

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from loadstone.catalog.registry import query
from loadstone.operators import changes, report
from loadstone.session import scratch_path
from loadstone.sources import Source, Warehouse, write_table

MARK = datetime(1999, 6, 1)
STEP = datetime(2000, 1, 15)

LOG_TYPES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


def run_log(t):
    kind = reduce(lambda acc, kv: acc.when(F.col("event_type") == kv[0], kv[1]), LOG_TYPES.items(), F.when(F.lit(False), 0))
    return t.events.select(
        F.col("event_id").alias("log_id"), F.col("ts").alias("log_timestamp"), kind.cast("bigint").alias("log_type_id")
    )


def event_calendar(t):
    """A day dimension over the days that have events."""
    day = F.to_date("ts")
    return t.events.select(day.alias("day")).distinct().select(
        F.datediff("day", F.lit("2000-01-01").cast("date")).alias("calendar_id"),
        F.year("day").alias("year"),
        F.month("day").alias("month_numeric"),
        F.dayofmonth("day").alias("day_of_month"),
    )


_LOG_SQL = """
WITH log AS (
  SELECT event_id AS log_id, ts AS log_timestamp,
         CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                         WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS log_type_id
  FROM events)
"""


@query(_LOG_SQL + """
SELECT CAST(log_type_id AS BIGINT) AS log_type_id, log_timestamp
FROM log l WHERE log_id = (SELECT max(log_id) FROM log m WHERE m.log_type_id = l.log_type_id)
""")
def hwm_read(t):
    """A1: the mark of each log type."""
    return changes.high_water_marks(run_log(t))


@query(_LOG_SQL + """
SELECT max(log_id) + 1 AS log_id, CAST(date_diff('day', DATE '2000-01-01', DATE '2024-01-15') AS BIGINT) AS calendar_id,
       TIMESTAMP '2024-01-15 10:30:00' AS log_timestamp, CAST(8 AS BIGINT) AS log_type_id
FROM log
""")
def hwm_commit(t):
    """A2: the run-log row of a finished run."""
    row = changes.commit_hwm(run_log(t), event_calendar(t), datetime(2024, 1, 15, 10, 30))
    return row.withColumns({c: F.col(c).cast("bigint") for c in ("calendar_id", "log_type_id")})


@query("""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01'
""")
def changed_rows(t):
    """Rows after the mark; the comparison is pushed into the scan."""
    return changes.changed_rows(t.orders, MARK, "o_orderdate").select("o_orderkey", "o_custkey", "o_orderdate")


@query("""
SELECT o_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate > TIMESTAMP '2000-01-15' OR o_orderdate > TIMESTAMP '2000-01-15'
""")
def changed_join_any(t):
    """Joined rows with a change in any table."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.filter(changes.is_changed(STEP, "l_shipdate", "o_orderdate")).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_orderdate"
    )


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01'
  UNION
  SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate > TIMESTAMP '2001-09-01')
""")
def changed_keys(t):
    """Customers touched by an order or by a line of one of their orders."""
    lines = t.lineitem.select("l_orderkey", "l_shipdate").filter(F.col("l_shipdate") > F.lit(datetime(2001, 9, 1)).cast("timestamp_ntz"))
    late = t.orders.select("o_orderkey", "o_custkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    by_order = changes.changed_keys([(t.orders, "o_custkey", ["o_orderdate"])], datetime(2001, 6, 1), "c_custkey")
    by_line = changes.changed_keys([(late, "o_custkey", ["l_shipdate"])], datetime(2001, 9, 1), "c_custkey")
    touched = by_order.unionByName(by_line).distinct()
    return t.customer.join(touched, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey) > TIMESTAMP '2001-06-01'
""")
def changed_by_child_max(t):
    """Orders whose latest line is after the mark."""
    return changes.changed_by_child(
        t.orders, t.lineitem, "o_orderkey", "l_orderkey", "l_shipdate", datetime(2001, 6, 1)
    ).select("o_orderkey", "o_orderstatus")


@query("""
SELECT 'first' AS load, o_orderkey FROM orders
UNION ALL
SELECT 'next', o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01' OR o_orderpriority <> '5-LOW'
UNION ALL
SELECT 'migrated', o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2006-12-01'
UNION ALL
SELECT 'epoch', o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1970-01-01'
""")
def first_run_switch(t):
    """A full load into an empty target, else changed rows or rows the migration did not write."""
    targets = {
        "first": (t.orders.filter(F.lit(False)), MARK),
        "next": (t.orders, MARK),
        "migrated": (t.orders, datetime(2006, 12, 1)),
    }
    parts = []
    for load, (target, hwm) in targets.items():
        rows = t.orders
        if not changes.is_first_run(target):
            rows = rows.filter(
                changes.is_changed(hwm, "o_orderdate") | changes.not_migrated(hwm, "o_orderpriority", marker="5-LOW")
            )
        parts.append(rows.select(F.lit(load).alias("load"), "o_orderkey"))
    epoch = changes.changed_rows(t.orders, changes.mark_or_epoch(None), "o_orderdate")
    parts.append(epoch.select(F.lit("epoch").alias("load"), "o_orderkey"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("""
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def multi_namespace(t):
    """One SQL query over tables of two source systems."""
    spark = t._spark
    source = Source(spark).add_folder("sales", t._folder).add_folder("common", t._folder)
    source.register("sales.customer", "common.nation")
    return spark.sql(
        "SELECT c_custkey, c_name, n_name FROM sales__customer JOIN common__nation ON c_nationkey = n_nationkey"
    )


@query("""
SELECT 'order_header' AS target, o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS detail FROM orders
UNION ALL
SELECT 'order_money', o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) FROM orders
""")
def paired_sink(t):
    """One set of rows feeds two tables."""
    rows = t.orders.withColumn("amount", F.col("o_totalprice").cast("decimal(18,2)"))
    parts = Warehouse(t._spark, "unused").split(
        rows, {"order_header": ["o_orderkey", "o_custkey"], "order_money": ["o_orderkey", "amount"]}
    )
    header = parts["order_header"].select(
        F.lit("order_header").alias("target"), F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("detail")
    )
    money = parts["order_money"].select(
        F.lit("order_money").alias("target"), F.col("o_orderkey").alias("id"), F.col("amount").cast("string").alias("detail")
    )
    return header.unionByName(money)


@query("""
SELECT 'customer' AS table_name, count(*) AS rows FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
""")
def load_report(t):
    """Rows per table."""
    return report.row_counts({"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem})


@query("""
SELECT 'customer' AS table_name, count(*) AS rows FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
""")
def load_report_written(t):
    """The rows a load reports, counted while they were written."""
    counted = []
    for name in ("customer", "orders"):
        watched = report.LoadReport(name)
        write_table(watched.watch(getattr(t, name)), f"{scratch_path(t._spark, 'report')}/{name}")
        counted.append((name, watched.finish().rows))
    return t._spark.createDataFrame(counted, "table_name string, rows long")
