"""Loads end to end: a warehouse filled from the derived source tables."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadstone.catalog import world
from loadstone.catalog.jobs import _RENAMED
from loadstone.operators import changes
from loadstone.plans import all_loads, run_loads
from loadstone.plans.core import LOADS, Load, Write
from loadstone.plans.schemas import SCHEMAS
from loadstone.sources import Source, Warehouse

OPTIONS = {"submission_dir": "file:/uploads/", "track_prizes": "contest_prize", "migration_cutover": "1990-01-01 00:00:00"}
NAMESPACES = ("main", "common", "time", "corporate", "connect")
MARK = datetime(1994, 1, 1)


@pytest.fixture(scope="module")
def source(spark, sf_dir, tmp_path_factory):
    system, folder = Source(spark), tmp_path_factory.mktemp("source")
    for namespace in NAMESPACES:
        def reader(table, namespace=namespace):
            name = _RENAMED.get(f"{namespace}.{table}", f"src_{table}")
            path = folder / name
            if not path.exists():
                world.spark_table(spark, sf_dir, name).coalesce(1).write.parquet(str(path))
            return spark.read.parquet(str(path))

        system.add(namespace, reader)
    return system


def new_warehouse(spark, sf_dir, folder, start, buckets=None):
    house = Warehouse(spark, str(folder), SCHEMAS, buckets)
    # The season and stage loads look up every day strictly.
    wanted = spark.sql("SELECT explode(sequence(DATE'1994-01-01', DATE'2002-12-31')) AS day")
    calendar = wanted.select(
        (F.datediff("day", F.lit("1994-01-01").cast("date")) + 1).cast("bigint").alias("calendar_id"),
        F.year("day").alias("year"), F.month("day").alias("month_numeric"), F.dayofmonth("day").alias("day_of_month"),
        F.col("day").cast("timestamp_ntz").alias("date"),
    )
    house.write("calendar", calendar)
    house.write("time", world.spark_table(spark, sf_dir, "dw_time"))
    log = spark.createDataFrame([(1, 1, start, 8)], SCHEMAS["update_log"])
    house.write("update_log", log)
    return house


def contents(house, table):
    frame = house.table(table)
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=repr)


CHAIN = [
    "contest", "event", "stage", "project", "project_platform", "submission_review", "submission", "payment", "participation",
    "project_result", "user_rating", "streak", "contest_result", "deleted_projects",
]


@pytest.fixture(scope="module")
def loaded(spark, sf_dir, source, tmp_path_factory):
    house = new_warehouse(spark, sf_dir, tmp_path_factory.mktemp("house"), MARK)
    reports = run_loads(spark, source, house, CHAIN, start=datetime(2001, 8, 1), options=OPTIONS)
    return house, reports


def test_all_loads_fill_their_tables(loaded):
    house, reports = loaded
    filled = {r.name for r in reports if r.rows > 0}
    assert {"project", "project_result", "payment", "user_payment", "participation", "streak"} <= filled
    assert changes.read_hwm(house.table("update_log")) == datetime(2001, 8, 1)


def test_no_deleted_project_is_left(loaded, source):
    house, _ = loaded
    gone = source.table("project").filter("project_status_id = 3").select("project_id")
    for table in ("project", "project_result", "submission_review", "submission"):
        assert house.table(table).join(gone, "project_id", "left_semi").count() == 0


def test_keys_stay_unique(loaded):
    house, _ = loaded
    for table, keys in (("project", ["project_id"]), ("project_result", ["project_id", "user_id"]), ("payment", ["payment_id"]),
                        ("submission_review", ["project_id", "user_id", "reviewer_id"])):
        frame = house.table(table)
        assert frame.select(*keys).distinct().count() == frame.count() > 0


def test_second_run_with_the_same_mark_changes_nothing(spark, loaded, source):
    house, _ = loaded
    names = ["contest", "project_platform", "submission_review", "submission", "payment", "participation", "streak"]
    tables = [*names, "user_payment"]
    before = {t: contents(house, t) for t in tables}
    log = house.table("update_log")
    house.write("update_log", spark.createDataFrame([(log.count() + 1, 1, MARK, 8)], SCHEMAS["update_log"]), "append")
    run_loads(spark, source, house, names, start=datetime(2001, 8, 1), options=OPTIONS)
    gone = {"submission"}
    for table in tables:
        if table not in gone:
            assert contents(house, table) == before[table], table
    assert set(before["submission"]) <= set(contents(house, "submission"))


def test_loads_into_buckets_give_the_same_tables(spark, sf_dir, source, tmp_path):
    """Two steps into tables in buckets, of which only the touched ones are read and rewritten, and one load into plain ones."""
    from loadstone.plans.schemas import BUCKETS

    names = ["project", "submission_review", "submission_screening", "payment", "dr_points", "appeal"]
    tables = ["submission_review", "submission_screening", "payment", "user_payment", "dr_points", "appeal"]
    start = datetime(2002, 1, 1)
    plain = new_warehouse(spark, sf_dir, tmp_path / "plain", MARK)
    run_loads(spark, source, plain, names, start=start, options=OPTIONS)
    house = new_warehouse(spark, sf_dir, tmp_path / "house", MARK, {k: (c, 4) for k, (c, _) in BUCKETS.items()})
    first, keys = Source(spark), {"review": "review_id", "payment_detail": "payment_detail_id", "dr_points": "track_id"}
    first.add("main", lambda t: source.table(t).filter(F.pmod(F.xxhash64(keys[t]), F.lit(2)) == 1) if t in keys else source.table(t))
    for namespace in NAMESPACES[1:]:
        first.add(namespace, lambda t, namespace=namespace: source.table(f"{namespace}.{t}"))
    run_loads(spark, first, house, names, start=start, options=OPTIONS)
    log = house.table("update_log")
    house.write("update_log", spark.createDataFrame([(log.count() + 1, 1, MARK, 8)], SCHEMAS["update_log"]), "append")
    run_loads(spark, source, house, names, start=start, options=OPTIONS)
    for table in tables:
        assert contents(house, table) == contents(plain, table) != [], table


def test_two_steps_equal_one_load(spark, sf_dir, source, tmp_path):
    names = ["contest", "event", "user_event_xref", "royalty", "scorecard_template"]
    one = new_warehouse(spark, sf_dir, tmp_path / "one", MARK)
    run_loads(spark, source, one, names, start=datetime(2002, 1, 1), options=OPTIONS)

    early = Source(spark)
    cut = F.lit(datetime(1998, 6, 1)).cast("timestamp_ntz")

    def until(table):
        frame = source.table(table)
        return frame.filter(F.col("modify_date") <= cut) if "modify_date" in frame.columns and not table.endswith("_lu") else frame

    early.add("main", until)
    two = new_warehouse(spark, sf_dir, tmp_path / "two", MARK)
    run_loads(spark, early, two, names, start=datetime(1998, 6, 1), options=OPTIONS)
    run_loads(spark, source, two, names, start=datetime(2002, 1, 1), options=OPTIONS)
    for name in names:
        assert contents(two, name) == contents(one, name), name


def test_ordered_columns_of_two_steps_equal_one_load(spark, sf_dir, source, tmp_path):
    """Rating counts and reviewer slots do not depend on how the rows were spread over loads."""
    names = ["project", "submission_review", "project_result"]
    start = datetime(2002, 1, 1)
    one = new_warehouse(spark, sf_dir, tmp_path / "one", MARK)
    run_loads(spark, source, one, names, start=start, options=OPTIONS)
    # The odd half of the reviewers and results comes first, so later rows fall between earlier ones.
    first, keys = Source(spark), {"review": "review_id", "project_result": "user_id"}
    first.add("main", lambda t: source.table(t).filter(F.pmod(F.xxhash64(keys[t]), F.lit(2)) == 1) if t in keys else source.table(t))
    for namespace in NAMESPACES[1:]:
        first.add(namespace, lambda t, namespace=namespace: source.table(f"{namespace}.{t}"))
    two = new_warehouse(spark, sf_dir, tmp_path / "two", MARK)
    run_loads(spark, first, two, names, start=start, options=OPTIONS)
    partly = two.table("project_result").count()
    log = two.table("update_log")
    two.write("update_log", spark.createDataFrame([(log.count() + 1, 1, MARK, 8)], SCHEMAS["update_log"]), "append")
    run_loads(spark, source, two, names, start=start, options=OPTIONS)
    assert 0 < partly < one.table("project_result").count()
    for table, columns in (("project_result", ["project_id", "user_id", "num_ratings"]), ("submission_review", ["project_id", "reviewer_id", "review_resp_id"])):
        rows = [sorted({tuple(r) for r in house.table(table).select(*columns).collect()}, key=repr) for house in (one, two)]
        assert rows[0] == rows[1] and rows[0], table


def test_failed_load_leaves_mark_and_table(spark, sf_dir, source, tmp_path):
    house = new_warehouse(spark, sf_dir, tmp_path, MARK)

    def broken(ctx):
        rows = ctx.target("event").sparkSession.range(3).select(
            F.raise_error(F.lit("broken")).cast("bigint").alias("event_id"), F.lit("x").alias("event_name")
        )
        return {"event": Write(rows)}

    all_loads()
    LOADS["broken_load"] = Load("broken_load", 1, broken)
    try:
        with pytest.raises(PySparkException):
            run_loads(spark, source, house, ["broken_load"], start=datetime(2001, 8, 1))
    finally:
        del LOADS["broken_load"]
    assert changes.read_hwm(house.table("update_log")) == MARK
    assert house.table("event").count() == 0


def test_backfill_fills_existing_projects_once(spark, loaded, source):
    house, _ = loaded
    ctx_columns = ["challenge_creator", "review_cost", "estimated_review_cost", "copilot_cost"]
    full = house.table("project")
    stripped = full.select(*[F.lit(None).cast(t).alias(c) if c in ctx_columns else F.col(c) for c, t in full.dtypes])
    from loadstone.plans.core import LoadContext

    ctx = LoadContext(source.table, lambda name: stripped if name == "project" else house.table(name), MARK, datetime(2001, 8, 1), OPTIONS)
    filled = all_loads()["project_backfill"].run(ctx)["project"].rows
    match = filled.alias("f").join(full.alias("o"), "project_id").filter("f.project_category_id <> 37 AND o.status_id = 7")
    assert match.filter("NOT (f.review_cost <=> o.review_cost) OR NOT (f.challenge_creator <=> o.challenge_creator)").count() == 0
    assert match.count() > 0
    again = LoadContext(source.table, lambda name: full if name == "project" else house.table(name), MARK, datetime(2001, 8, 1), OPTIONS)
    assert all_loads()["project_backfill"].run(again) == {}
