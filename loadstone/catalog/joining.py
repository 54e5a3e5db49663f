"""Projections, filters and joins (B*, C*) on the test tables."""

from pyspark.sql import functions as F

from loadstone.catalog.registry import query
from loadstone.functions import scalar
from loadstone.operators import joins


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


@query("""
SELECT DISTINCT o_orderkey + 111 AS phase_id, o_custkey,
       CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 1 ELSE 2 END AS status_id,
       CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status_desc,
       1 AS level_id
FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderstatus <> 'P'
  AND o_totalprice BETWEEN 50000 AND 300000 AND o_orderdate IS NOT NULL
""")
def filters_case(t):
    """Projection, arithmetic, list and range filters, codes to labels."""
    status = F.col("o_orderstatus")
    return (
        t.orders.filter(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")
            & (status != "P")
            & F.col("o_totalprice").between(50000, 300000)
            & F.col("o_orderdate").isNotNull()
        )
        .select(
            (F.col("o_orderkey") + 111).alias("phase_id"),
            "o_custkey",
            F.when(status == "F", 3).when(status == "O", 1).otherwise(2).alias("status_id"),
            F.when(status == "F", "Finished").when(status == "O", "Open").otherwise("Pending").alias("status_desc"),
            F.lit(1).alias("level_id"),
        )
        .distinct()
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE l_linenumber WHEN 1 THEN nullif(l_orderkey, 0) WHEN 2 THEN nullif(l_partkey, 0) WHEN 3 THEN nullif(l_suppkey, 0) END AS reference_id
FROM lineitem
""")
def code_column_pick(t):
    """The id column a code points to; 0 and unknown codes give null."""
    picked = scalar.pick_by_code("l_linenumber", {1: "l_orderkey", 2: "l_partkey", 3: "l_suppkey"})
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", picked.alias("reference_id"))


@query("""
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'delete' ELSE 'load' END AS route FROM part
WHERE p_type = 'ECONOMY' OR p_size <= 30
""")
def version_split(t):
    """Rows in a deleted state go one way, the others only below a version limit."""
    deleted = t.part.filter(F.col("p_type") == "ECONOMY").select("p_partkey", F.lit("delete").alias("route"))
    loaded = t.part.filter((F.col("p_type") != "ECONOMY") & (F.col("p_size") <= 30)).select("p_partkey", F.lit("load").alias("route"))
    return deleted.unionByName(loaded)


@query("""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-01' AND o_orderpriority = '1-URGENT')
""")
def anti_exclusion(t):
    """Customers without a late urgent order."""
    late = t.orders.filter((F.col("o_orderdate") > stamp("2000-06-01")) & (F.col("o_orderpriority") == "1-URGENT"))
    return joins.excluding(t.customer, late, {"c_custkey": "o_custkey"}).select("c_custkey", "c_name")


_NOT_IN = """
SELECT {n} AS variant, c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT {key} FROM orders WHERE o_orderpriority = '1-URGENT')
"""


@query(
    _NOT_IN.format(n=1, key="o_custkey") + " UNION ALL "
    + _NOT_IN.format(n=2, key="CASE WHEN o_orderstatus = 'F' THEN o_custkey END")
)
def not_in_null_aware(t):
    """The rule of NOT IN; a null in the list rejects every row."""
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    with_null = urgent.withColumn("o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")))
    parts = [
        joins.excluding(t.customer, keys, {"c_custkey": "o_custkey"}, null_aware=True).select(F.lit(n).alias("variant"), "c_custkey")
        for n, keys in ((1, urgent), (2, with_null))
    ]
    return parts[0].unionByName(parts[1])


@query("""
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000) THEN 1 ELSE 0 END AS has_big_order
FROM customer
""")
def exists_flag(t):
    """1 where a matching row exists."""
    big = t.orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.exists_flag(t.customer.select("c_custkey"), big, ["c_custkey"], "has_big_order")


@query("""
SELECT r_name, n_name, c_custkey, o_orderkey, l_linenumber, l_partkey, p_brand, s_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
""")
def multi_join(t):
    """Equi-join of seven tables."""
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("r_name", "n_name", "c_custkey", "o_orderkey", "l_linenumber", "l_partkey", "p_brand", "s_name")
    )


@query("""
SELECT c_custkey, o_orderkey FROM customer
LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '2-HIGH' AND o_orderdate > TIMESTAMP '2000-01-01'
""")
def outer_filtered(t):
    """Conditions on the optional side belong to the join and drop no customer."""
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    where = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderdate") > stamp("2000-01-01"))
    return joins.left_where(t.customer, orders, ["c_custkey"], where).select("c_custkey", "o_orderkey")


@query("""
SELECT c_custkey, x.o_orderkey, x.l_linenumber FROM customer
LEFT JOIN (SELECT o_custkey, o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey
           WHERE o_orderpriority = '1-URGENT' AND l_quantity > 45) x ON x.o_custkey = c_custkey
""")
def outer_nested(t):
    """C4: left join to an inner join."""
    inner = (
        t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .join(t.lineitem.filter(F.col("l_quantity") > 45), F.col("o_orderkey") == F.col("l_orderkey"))
        .select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "l_linenumber")
    )
    return joins.left_where(t.customer, inner, ["c_custkey"]).select("c_custkey", "o_orderkey", "l_linenumber")


@query("""
WITH eav AS (SELECT user_id, event_type, CASE WHEN value > 30 THEN 'On' WHEN value < 0.5 THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS v FROM events)
SELECT user_id,
       max(CASE WHEN event_type = 'click' THEN v END) AS clicks,
       CASE WHEN max(CASE WHEN event_type = 'purchase' THEN v END) = 'On' THEN 1 ELSE 0 END AS purchase_flag,
       TRY_CAST(max(CASE WHEN event_type = 'view' THEN v END) AS DECIMAL(18,2)) AS view_amount,
       TRY_CAST(min(CASE WHEN event_type = 'error' THEN v END) AS DECIMAL(18,2)) AS lowest_error
FROM eav GROUP BY user_id
""")
def attribute_pivot(t):
    """Attribute rows to columns in one pass, then casts that give null for other text."""
    value = F.col("value")
    attributes = t.events.select(
        "user_id",
        F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", 2)
        .when(F.col("event_type") == "view", 3).when(F.col("event_type") == "error", 4).otherwise(5).alias("attribute_id"),
        F.when(value > 30, "On").when(value < 0.5, "n/a").otherwise(value.cast("decimal(18,2)").cast("string")).alias("value"),
    )
    wide = joins.pivot_attributes(
        attributes, "user_id", {"clicks": 1, "purchase": 2, "view": 3}, "attribute_id"
    )
    lowest = attributes.groupBy("user_id").agg(F.min(F.when(F.col("attribute_id") == 4, F.col("value"))).alias("lowest"))
    return lowest.join(wide, "user_id", "left").select(
        "user_id", "clicks",
        scalar.flag("purchase", "On").alias("purchase_flag"),
        scalar.to_money("view").alias("view_amount"),
        scalar.to_money("lowest").alias("lowest_error"),
    )


def order_calendar(t):
    day = F.to_date("o_orderdate")
    return t.orders.select(day.alias("day")).distinct().select(
        F.datediff("day", F.lit("1990-01-01").cast("date")).cast("bigint").alias("calendar_id"),
        F.year("day").alias("year"), F.month("day").alias("month_numeric"), F.dayofmonth("day").alias("day_of_month"),
    )


@query("""
WITH cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CAST(date_diff('day', DATE '1990-01-01', day) AS BIGINT) AS ship_calendar_id
FROM lineitem LEFT JOIN cal ON CAST(l_shipdate AS DATE) = day
""")
def calendar_lookup(t):
    """Day id by year, month and day; a day the calendar lacks gives null."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return joins.calendar_lookup(lines, order_calendar(t), {"ship_calendar_id": "l_shipdate"})


@query("""
SELECT o_orderkey, CAST(date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS order_calendar_id FROM orders
""")
def calendar_lookup_strict(t):
    """As above, but a missing day fails the load."""
    found = joins.calendar_lookup(t.orders, order_calendar(t), {"order_calendar_id": "o_orderdate"}, strict=True)
    return found.select("o_orderkey", "order_calendar_id")


@query("""
SELECT event_id, CAST(hour(ts) * 60 + minute(ts) AS BIGINT) AS time_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day
FROM events
""")
def time_lookup(t):
    """Time-of-day id by hour and minute."""
    stamps = t.events.select((F.hour("ts")).alias("hour_24"), F.minute("ts").alias("minute")).distinct()
    times = stamps.withColumn("time_id", (F.col("hour_24") * 60 + F.col("minute")).cast("bigint"))
    found = joins.time_lookup(t.events, times, {"time_id": "ts"}, strict=True)
    return found.select("event_id", "time_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))


@query("""
SELECT c_custkey, c_nationkey, n_name AS nation_desc, r_name AS region_desc
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def lookup_denorm(t):
    """Ids with their descriptions."""
    nations = joins.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, {"region_desc": "r_name"})
    found = joins.lookup(
        t.customer, nations, {"c_nationkey": "n_nationkey"}, {"nation_desc": "n_name", "region_desc": "region_desc"}
    )
    return found.select("c_custkey", "c_nationkey", "nation_desc", "region_desc")


_STAGES = """
SELECT CAST(min(o_orderdate) AS TIMESTAMP) AS start_date, CAST(max(o_orderdate) AS TIMESTAMP) AS end_date,
       year(o_orderdate) * 10 + quarter(o_orderdate) AS stage_id
FROM orders GROUP BY 3
"""


def stages(t):
    stage = (F.year("o_orderdate") * 10 + F.quarter("o_orderdate")).cast("bigint")
    return t.orders.groupBy(stage.alias("stage_id")).agg(
        F.min("o_orderdate").alias("start_date"), F.max("o_orderdate").alias("end_date")
    )


@query(f"""
WITH stage AS ({_STAGES})
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, stage_id FROM lineitem
LEFT JOIN stage ON l_shipdate BETWEEN start_date AND end_date
""")
def range_join(t):
    """The stage a date falls in; no stage gives null."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return joins.range_join(lines, stages(t), "l_shipdate", "start_date", "end_date").drop("start_date", "end_date")


@query(f"""
WITH stage AS ({_STAGES}),
     p AS (SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END, first_ship) AS posted
           FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)
SELECT DISTINCT stage_id, o_orderkey, posted FROM p JOIN stage ON posted BETWEEN start_date AND end_date
""")
def range_coalesced(t):
    """Stages of a date that falls back to another one."""
    first = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("first_ship"))
    posted = t.orders.join(first, "o_orderkey").select(
        "o_orderkey", F.coalesce(F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")), "first_ship").alias("posted")
    )
    return joins.range_join(posted, stages(t), "posted", "start_date", "end_date", how="inner").select(
        "stage_id", "o_orderkey", "posted"
    ).distinct()


@query("""
WITH track AS (
  SELECT c_mktsegment AS segment, year(o_orderdate) AS track_id, min(o_orderdate) AS start_date, max(o_orderdate) + INTERVAL 90 DAY AS end_date
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2)
SELECT o_orderkey, segment, track_id FROM orders JOIN customer ON o_custkey = c_custkey
JOIN track ON segment = c_mktsegment AND o_orderdate BETWEEN start_date AND end_date
""")
def range_equi_join(t):
    """C14: equal category and a date in the track's interval; several tracks may match."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_mktsegment", "segment")
    tracks = orders.filter(F.col("o_orderpriority") == "1-URGENT").groupBy(
        "segment", F.year("o_orderdate").cast("bigint").alias("track_id")
    ).agg(
        F.min("o_orderdate").alias("start_date"), (F.max("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("end_date")
    )
    return joins.range_join(
        orders, tracks, "o_orderdate", "start_date", "end_date", on=["segment"], how="inner"
    ).select("o_orderkey", "segment", "track_id")


@query("""
SELECT a.event_id, a.user_id, CASE WHEN a.event_type = 'purchase'
       THEN CAST(coalesce(b.value, 0) AS DECIMAL(18,2)) * CAST(a.value AS DECIMAL(18,2)) / 100 ELSE CAST(a.value AS DECIMAL(18,2)) END AS amount
FROM events a LEFT JOIN events b ON b.event_id = a.event_id - 1
""")
def parent_amount(t):
    """Percentage rows take the amount of the row they refer to."""
    points = t.events.select(
        F.col("event_id").alias("dr_points_id"), "user_id", (F.col("event_id") - 1).alias("reference_id"),
        F.when(F.col("event_type") == "purchase", 2).otherwise(1).alias("dr_points_reference_type_id"),
        F.when(F.col("event_type") == "purchase", 2).otherwise(1).alias("dr_points_operation_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )
    return joins.with_parent_amount(points).select(
        F.col("dr_points_id").alias("event_id"), "user_id", F.col("amount").cast("double").alias("amount")
    )


@query("""
SELECT a.o_orderkey AS base_id, b.o_orderkey AS linked_id, b.o_orderstatus AS linked_status
FROM orders a JOIN lineitem ON l_orderkey = a.o_orderkey AND l_linenumber = 1
JOIN orders b ON b.o_orderkey = l_partkey AND b.o_orderpriority = '3-MEDIUM'
""")
def link_join(t):
    """C17: a table joined to itself through a table of links."""
    links = t.lineitem.filter(F.col("l_linenumber") == 1).select("l_orderkey", "l_partkey")
    found = joins.linked(
        t.orders, links, "o_orderkey", "l_orderkey", "l_partkey",
        {"linked_id": "o_orderkey", "linked_status": "o_orderstatus"}, F.col("o_orderpriority") == "3-MEDIUM",
    )
    return found.select(F.col("o_orderkey").alias("base_id"), "linked_id", "linked_status")


@query("""
WITH head AS (SELECT o_custkey, max(o_orderkey) AS most_recent_detail_id FROM orders GROUP BY 1)
SELECT c_custkey, o_orderkey, o_orderdate FROM customer JOIN head ON head.o_custkey = c_custkey
JOIN orders ON o_orderkey = most_recent_detail_id
""")
def latest_detail(t):
    """A header and the one detail it points to."""
    pointer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("most_recent_detail_id"))
    heads = t.customer.join(pointer, "c_custkey")
    return joins.latest_detail(heads, t.orders, "most_recent_detail_id", "o_orderkey").select(
        "c_custkey", "o_orderkey", "o_orderdate"
    )


@query("""
SELECT o_custkey, o_orderkey AS first_order, o_orderpriority AS first_priority FROM orders
WHERE (o_custkey, o_orderkey) IN (SELECT o_custkey, min(o_orderkey) FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
""")
def first_related(t):
    """C20: per parent the child with the smallest id."""
    done = t.orders.filter(F.col("o_orderstatus") == "F")
    return joins.first_related(done, "o_custkey", "o_orderkey", {"first_order": "o_orderkey", "first_priority": "o_orderpriority"})


