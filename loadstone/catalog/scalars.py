"""Scalar rules (F*) on the test tables."""

from pyspark.sql import functions as F

from loadstone.catalog.registry import query
from loadstone.functions import fixed, scalar

# Forms the source writes dates in, chosen by the order key.
_TEXT_DATES = """
CASE CAST(o_orderkey % 12 AS INTEGER)
  WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') || ' 09:30'
  WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') || ' 13:15'
  WHEN 2 THEN strftime(o_orderdate, '%m.%d.%Y') || ' 12:05 PM'
  WHEN 3 THEN strftime(o_orderdate, '%a %b %d') || ' 23:10:09 EST ' || strftime(o_orderdate, '%Y')
  WHEN 4 THEN strftime(o_orderdate, '%m.%d.%Y') || ' 21:30 GMT+02:00'
  WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 04:05:06'
  WHEN 6 THEN strftime(o_orderdate, '%m/%d/%Y') || ' 12:40 tail'
  WHEN 7 THEN strftime(o_orderdate, '%a %b %d') || ' 23:10:09 CET ' || strftime(o_orderdate, '%Y')
  WHEN 8 THEN strftime(o_orderdate, '%m.%d.%Y') || ' 01:30 IST'
  WHEN 9 THEN strftime(o_orderdate, '%m.%d.%Y') || ' 21:30 America/New_York'
  WHEN 10 THEN strftime(o_orderdate, '%m.%d.%Y') || ' 21:30 No/Where'
  ELSE 'on ' || o_orderpriority END
"""


def text_dates(t):
    date = lambda pattern: F.date_format("o_orderdate", pattern)
    forms = [
        F.concat(date("MM/dd/yyyy"), F.lit(" 09:30")),
        F.concat(date("MM/dd/yyyy"), F.lit(" 13:15")),
        F.concat(date("MM.dd.yyyy"), F.lit(" 12:05 PM")),
        F.concat(date("EEE MMM dd"), F.lit(" 23:10:09 EST "), date("yyyy")),
        F.concat(date("MM.dd.yyyy"), F.lit(" 21:30 GMT+02:00")),
        F.concat(date("yyyy-MM-dd"), F.lit(" 04:05:06")),
        F.concat(date("MM/dd/yyyy"), F.lit(" 12:40 tail")),
        F.concat(date("EEE MMM dd"), F.lit(" 23:10:09 CET "), date("yyyy")),
        F.concat(date("MM.dd.yyyy"), F.lit(" 01:30 IST")),
        F.concat(date("MM.dd.yyyy"), F.lit(" 21:30 America/New_York")),
        F.concat(date("MM.dd.yyyy"), F.lit(" 21:30 No/Where")),
    ]
    text = F.concat(F.lit("on "), F.col("o_orderpriority"))
    for number, form in enumerate(forms):
        text = F.when(F.col("o_orderkey") % 12 == number, form).otherwise(text)
    return t.orders.withColumn("text", text)


@query(f"""
SELECT o_orderkey, {_TEXT_DATES} AS text,
       CASE WHEN o_orderkey % 12 = 9 THEN timezone('UTC', timezone('America/New_York', CAST(o_orderdate AS TIMESTAMP) + to_seconds(1290 * 60)))
         ELSE o_orderdate + to_seconds(CASE CAST(o_orderkey % 12 AS INTEGER)
         WHEN 0 THEN 570 * 60 WHEN 1 THEN 795 * 60 WHEN 2 THEN 725 * 60 WHEN 3 THEN 23 * 3600 + 609 + 5 * 3600
         WHEN 4 THEN 1290 * 60 - 7200 WHEN 5 THEN 4 * 3600 + 306 WHEN 6 THEN 40 * 60
         WHEN 7 THEN 23 * 3600 + 609 - 3600 WHEN 8 THEN 90 * 60 - 330 * 60 END) END AS stamp
FROM orders
""")
def parse_timestamps(t):
    """five text forms tried in order, null for any other text."""
    return text_dates(t).select("o_orderkey", "text", scalar.parse_timestamp("text").alias("stamp"))


_ANSWER = """
CASE WHEN l_linenumber = 1 THEN CAST(CAST(l_quantity AS INTEGER) % 6 AS VARCHAR) || '/4'
     WHEN l_linenumber = 2 THEN CAST(CAST(l_quantity AS INTEGER) % 12 AS VARCHAR)
     WHEN l_linenumber = 3 THEN CAST(CAST(l_quantity AS INTEGER) % 12 AS VARCHAR) || '/10'
     WHEN l_linenumber = 4 THEN 'Yes' WHEN l_linenumber = 5 THEN ' ' WHEN l_linenumber = 6 THEN 'abc' END
"""


@query(f"""
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey % 6 AS BIGINT) AS question_type, {_ANSWER} AS answer FROM lineitem),
four AS (SELECT *, CASE WHEN answer IN ('1', '1/4') THEN 1 WHEN answer IN ('2', '2/4') THEN 2 WHEN answer IN ('3', '3/4') THEN 3 WHEN answer IN ('4', '4/4') THEN 4 END AS f,
         CASE WHEN regexp_full_match(answer, '(10|[1-9])(/10)?') THEN 10 + CAST(split_part(answer, '/', 1) AS INTEGER) END AS n FROM a)
SELECT l_orderkey, l_linenumber, l_partkey, question_type, answer,
       nullif(CASE WHEN answer IS NULL OR trim(answer) = '' THEN NULL
            WHEN question_type = 1 THEN coalesce(f, n) WHEN question_type = 2 THEN n WHEN question_type = 3 THEN NULL
            WHEN question_type = 4 THEN CASE WHEN answer IN ('Yes', '1') THEN 5 ELSE 6 END
            ELSE TRY_CAST(answer AS INTEGER) END, 0) AS evaluation_id
FROM four
""")
def eval_code(t):
    """answer to evaluation id by question type."""
    quantity = F.col("l_quantity").cast("int")
    number = F.col("l_linenumber")
    answer = (
        F.when(number == 1, F.concat((quantity % 6).cast("string"), F.lit("/4")))
        .when(number == 2, (quantity % 12).cast("string"))
        .when(number == 3, F.concat((quantity % 12).cast("string"), F.lit("/10")))
        .when(number == 4, "Yes").when(number == 5, " ").when(number == 6, "abc")
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") % 6).alias("question_type"), answer.alias("answer"))
    return rows.withColumn("evaluation_id", scalar.evaluation_id("question_type", "answer"))


@query("""
WITH a AS (SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN CAST(o_custkey % 9 AS VARCHAR) || '/' || CAST(o_custkey % 11 AS VARCHAR)
             WHEN 1 THEN 'x/' || CAST(o_custkey % 11 AS VARCHAR) WHEN 2 THEN CAST(o_custkey % 11 AS VARCHAR) || '/' WHEN 3 THEN CAST(o_custkey AS VARCHAR) END AS answer FROM orders)
SELECT o_orderkey, answer, CASE WHEN o_orderkey % 5 = 0 THEN CAST(split_part(answer, '/', 1) AS INTEGER) ELSE 1 END AS passed,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(split_part(answer, '/', 2) AS INTEGER) ELSE 1 END AS total,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(split_part(answer, '/', 1) AS INTEGER) WHEN o_orderkey % 5 = 1 THEN NULL ELSE 1 END AS raw_passed
FROM a
""")
def split_ratio(t):
    """passed and total of a ratio text, 1 where it is none."""
    key, cust = F.col("o_orderkey") % 5, F.col("o_custkey")
    text = lambda n: (cust % n).cast("string")
    answer = (
        F.when(key == 0, F.concat(text(9), F.lit("/"), text(11))).when(key == 1, F.concat(F.lit("x/"), text(11)))
        .when(key == 2, F.concat(text(11), F.lit("/"))).when(key == 3, cust.cast("string"))
    )
    return t.orders.select("o_orderkey", answer.alias("answer")).select(
        "*",
        scalar.ratio_part("answer", 1).alias("passed"),
        scalar.ratio_part("answer", 2).alias("total"),
        scalar.ratio_part("answer", 1, checked=False).alias("raw_passed"),
    )


@query(r"""
WITH c AS (SELECT doc_id, text, length(substr(text, 1, 251)) AS n FROM documents),
d AS (
  SELECT doc_id, text, n, CASE WHEN strpos(substr(text, 1, 251), chr(10)) > 0 THEN n - strpos(reverse(substr(text, 1, 251)), chr(10)) + 1 END AS nl,
         CASE WHEN strpos(substr(text, 1, 251), ' ') > 0 THEN n - strpos(reverse(substr(text, 1, 251)), ' ') + 1 END AS blank FROM c)
SELECT doc_id, CASE WHEN nl IS NOT NULL THEN substr(text, 1, nl) || '...' WHEN blank IS NOT NULL THEN substr(text, 1, blank - 1) || '...' ELSE text END AS header
FROM d
""")
def header_cut(t):
    """head of each text, cut at the last line break or blank near position 250."""
    return t.documents.select("doc_id", scalar.header_cut("text").alias("header"))


@query(r"""
WITH p AS (SELECT page_id, CASE CAST(page_id % 3 AS INTEGER) WHEN 0 THEN url WHEN 1 THEN '/' || regexp_replace(url, '[^a-z]', '', 'g') ELSE regexp_replace(url, '[^a-z]', '', 'g') END AS path FROM pages)
SELECT page_id, path, CASE WHEN strpos(path, '/') <= 1 THEN 'file:/uploads/' || path ELSE path END AS submission_url FROM p
""")
def path_prefix(t):
    """the folder goes before a path that names none."""
    bare = F.regexp_replace("url", "[^a-z]", "")
    kind = F.col("page_id") % 3
    path = F.when(kind == 0, F.col("url")).when(kind == 1, F.concat(F.lit("/"), bare)).otherwise(bare)
    return t.pages.select("page_id", path.alias("path")).withColumn("submission_url", scalar.path_prefix("path", "file:/uploads"))


@query("""
SELECT c_custkey, CASE WHEN c_nationkey > 20 THEN '' ELSE lpad(trim(' ' || CAST(c_nationkey * 7 AS VARCHAR) || ' '), 3, '0') END AS country_code,
       coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '') AS state_code,
       substr(c_name, 1, 8) || ' - ' || c_mktsegment AS project_desc
FROM customer
""")
def pad_code(t):
    """Padded codes, null to the empty text, concatenation."""
    code = F.when(F.col("c_nationkey") <= 20, F.concat(F.lit(" "), (F.col("c_nationkey") * 7).cast("string"), F.lit(" ")))
    return t.customer.select(
        "c_custkey",
        scalar.pad_code(code).alias("country_code"),
        scalar.text_or_empty(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))).alias("state_code"),
        F.concat(F.substring("c_name", 1, 8), F.lit(" - "), "c_mktsegment").alias("project_desc"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate AS posted, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS done,
       CASE WHEN l_returnflag <> 'R' AND l_shipdate >= o_orderdate THEN date_diff('second', o_orderdate, l_shipdate) // 60 END AS duration,
       CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS day, year(l_shipdate) AS y, month(l_shipdate) AS m, day(l_shipdate) AS d
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def duration_min(t):
    """Whole minutes between two dates, null if negative or open."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    done = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("o_orderdate").alias("posted"), done.alias("done"),
        scalar.duration_minutes("o_orderdate", done).alias("duration"),
        F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("day"),
        F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), F.dayofmonth("l_shipdate").alias("d"),
    )


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'Succeeded' WHEN 'view' THEN 'Failed' WHEN 'error' THEN 'On' END AS text,
       CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 WHEN 'error' THEN 0 END AS successful_ind,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS run_ind, CAST(round(value) AS BIGINT) AS rounded,
       coalesce(CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS BIGINT) END, -2) AS rating_id,
       CASE WHEN floor(value) > 0 THEN CAST(floor(value) AS BIGINT) END AS billing_id,
       TRY_CAST(CASE WHEN event_type = 'view' THEN 'n/a' ELSE CAST(floor(value) AS BIGINT)::VARCHAR END AS BIGINT) AS parsed
FROM events
""")
def flags(t):
    """Text flags, rounding, sentinel and null rules."""
    kind = F.col("event_type")
    whole = F.floor("value").cast("bigint")
    rows = t.events.select(
        "event_id", "value", F.when(kind == "click", "Succeeded").when(kind == "view", "Failed").when(kind == "error", "On").alias("text"),
        F.when(kind != "view", whole).alias("rating"), whole.cast("string").alias("billing"),
        F.when(kind == "view", "n/a").otherwise(whole.cast("string")).alias("number"),
    )
    return rows.select(
        "event_id", "text", scalar.success_flag("text").alias("successful_ind"), scalar.flag("text", "On", "Yes").alias("run_ind"),
        F.round("value").cast("bigint").alias("rounded"), scalar.rating_key("rating").alias("rating_id"),
        scalar.billing_id("billing").alias("billing_id"), scalar.to_long("number").alias("parsed"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 0.05::DOUBLE * o_totalprice
            WHEN o_orderkey % 12 IN (4, 5, 6, 8, 11) THEN 0 ELSE 250 END AS admin_fee
FROM orders
""")
def fee_rule(t):
    """F16: a fixed fee, none for cancelled states, or a share of the prizes."""
    percentage = F.when(F.col("o_custkey") % 4 == 0, 0.05).when(F.col("o_custkey") % 4 == 1, 0.000001)
    return t.orders.select(
        "o_orderkey", scalar.admin_fee(F.col("o_orderkey") % 12, F.lit(250.0), percentage, "o_totalprice").alias("admin_fee")
    )


_SHARES = " UNION ALL ".join(
    f"SELECT {n + 1} AS n, {p + 1} AS p, {share}::DOUBLE AS share"
    for n, row in enumerate(fixed.PLACEMENT_SHARES) for p, share in enumerate(row)
)


@query(f"""
WITH shares AS ({_SHARES}),
r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS total, CAST(l_suppkey % 8 AS BIGINT) AS placements, CAST(l_quantity AS BIGINT) % 7 AS place FROM lineitem)
SELECT r.*, coalesce(CASE WHEN total > 0 THEN floor(total * share * 100.0 + 0.5) / 100.0 END, 0) AS points
FROM r LEFT JOIN shares ON n = least(placements, 5) AND p = place
""")
def placement_points(t):
    """points of a place by the number of placements, rounded half up."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("total"),
        (F.col("l_suppkey") % 8).alias("placements"), (F.col("l_quantity").cast("bigint") % 7).alias("place"),
    )
    return rows.withColumn("points", scalar.placement_points("total", "placements", "place"))


@query("""
SELECT event_id, CASE WHEN v = 0 THEN NULL ELSE 100 * (CASE WHEN event_type = 'purchase' THEN value ELSE 0 END / v) END AS taxable_prize,
       CASE WHEN event_type = 'signup' THEN 40 * value / 100 ELSE value END AS amount
FROM (SELECT *, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS v FROM events)
""")
def taxable_share(t):
    """Percentage of a parent amount and the taxable part of a prize."""
    kind, value = F.col("event_type"), F.col("value")
    return t.events.select(
        "event_id",
        scalar.taxable_share(F.lit(100.0), F.when(kind == "purchase", value).otherwise(0.0), F.when(kind == "error", 0.0).otherwise(value)).alias("taxable_prize"),
        scalar.operation_amount(F.when(kind == "signup", 2).otherwise(1), value, F.lit(40.0)).alias("amount"),
    )
