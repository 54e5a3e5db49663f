"""Change capture, write modes, joins and aggregates on hand-made rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadstone.catalog import world
from loadstone.functions import fixed
from loadstone.operators import aggregates, changes, joins, merge, report, scoring
from loadstone.plans.core import LoadContext
from loadstone.plans.projects import people, touched_matches
from loadstone.session import settle
from loadstone.sources import Source, Warehouse, read_table, write_table

DAY = [datetime(2009, 1, d) for d in range(1, 29)]


def rows(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_marks(spark):
    log = spark.createDataFrame(
        [(1, 5, DAY[9], 8), (3, 6, DAY[4], 8), (2, 7, DAY[20], 4)],
        "log_id bigint, calendar_id bigint, log_timestamp timestamp_ntz, log_type_id bigint",
    )
    assert changes.read_hwm(log) == DAY[4]
    with pytest.raises(LookupError):
        changes.read_hwm(log, 99)
    calendar = spark.createDataFrame([(77, 2009, 1, 5)], "calendar_id bigint, year int, month_numeric int, day_of_month int")
    assert rows(changes.commit_hwm(log, calendar, DAY[4])) == [(4, 77, DAY[4], 8)]
    with pytest.raises(PySparkException):
        changes.commit_hwm(log, calendar, DAY[5])


def test_changed_rows_are_strictly_after_the_mark(spark):
    frame = spark.createDataFrame(
        [(1, DAY[0], DAY[5]), (2, DAY[3], None), (3, None, None), (4, DAY[2], DAY[3])], "id int, a timestamp_ntz, b timestamp_ntz"
    )
    assert rows(frame.filter(changes.is_changed(DAY[3], "a", "b")), "id") == [(1,)]
    assert rows(frame.filter(changes.is_changed(DAY[3], "a", inclusive=["b"])), "id") == [(1,), (4,)]
    plan = frame.filter(changes.is_changed(DAY[3], "a"))._jdf.queryExecution().optimizedPlan().toString()
    assert "greatest" not in plan


def test_migration_window(spark):
    frame = spark.createDataFrame([("Converter",), ("x",), (None,)], "u string")
    assert rows(frame.filter(changes.not_migrated(DAY[0], "u"))) == []
    assert rows(frame.filter(changes.not_migrated(datetime(2006, 1, 1), "u"))) == [("x",)]
    assert rows(frame.filter(changes.not_migrated(None, "u"))) == [("x",)]


def test_changed_keys(spark):
    a = spark.createDataFrame([(1, DAY[5]), (2, DAY[0]), (None, DAY[5])], "k int, m timestamp_ntz")
    b = spark.createDataFrame([(3, DAY[0], DAY[6]), (1, DAY[6], None)], "k int, c timestamp_ntz, m timestamp_ntz")
    assert rows(changes.changed_keys([(a, "k", ["m"]), (b, "k", ["c", "m"])], DAY[3], "id")) == [(1,), (3,)]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "k int, t string, v double")


def test_upsert(spark, target):
    delta = spark.createDataFrame([(2, "x", 9.0, 1), (2, "y", 8.0, 2), (4, "z", 7.0, 1)], "k int, t string, v double, seq int")
    assert rows(merge.upsert(target, delta, ["k"], ["seq"])) == [(1, "a", 1.0), (2, "y", 8.0), (3, "c", None), (4, "z", 7.0)]
    partial = merge.upsert(target, delta, ["k"], ["seq"], update=["t"])
    assert rows(partial) == [(1, "a", 1.0), (2, "y", 2.0), (3, "c", None), (4, "z", 7.0)]
    narrow = merge.upsert(target, delta.select("k", "t", "seq"), ["k"], ["seq"])
    assert rows(narrow) == [(1, "a", 1.0), (2, "y", 2.0), (3, "c", None), (4, "z", None)]


def test_upsert_twice_changes_nothing(spark, target):
    delta = spark.createDataFrame([(2, "x", 9.0), (5, "n", None)], target.schema)
    once = merge.upsert(target, delta, ["k"])
    assert rows(merge.upsert(once, delta, ["k"])) == rows(once)


def test_unique_check(spark, target):
    assert rows(merge.assert_unique(target, ["k"])) == rows(target)
    with pytest.raises(PySparkException):
        merge.assert_unique(target.union(target), ["k"]).collect()


def test_replace_and_delete(spark, target):
    fresh = spark.createDataFrame([(2, "n1", 0.0), (2, "n2", 0.0)], target.schema)
    touched = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(merge.replace_by_key(target, fresh, ["k"]), "k", "t") == [(1, "a"), (2, "n1"), (2, "n2"), (3, "c")]
    assert rows(merge.replace_by_key(target, fresh, ["k"], touched), "k", "t") == [(1, "a"), (2, "n1"), (2, "n2")]
    assert rows(merge.delete_keys(target, touched, "k"), "k") == [(1,)]
    left = merge.cascade_delete({"a": target, "b": target}, [("a", "k"), ("none", "k")], touched)
    assert rows(left["a"], "k") == [(1,)] and left["b"] is target


def test_append_and_backfill(spark, target):
    more = spark.createDataFrame([(1, "a", 1.0), (3, "c", None), (9, None, None), (9, None, None)], target.schema)
    assert rows(merge.append_new(target, more, ["k", "t", "v"])) == [(9, None, None)]
    empty = target.withColumn("v", F.lit(None).cast("double"))
    source = spark.createDataFrame([(1, 5.0), (8, 6.0)], "k int, v double")
    assert rows(merge.backfill(empty, source, ["k"], ["v"]), "k", "v") == [(1, 5.0), (2, None), (3, None)]
    assert rows(merge.backfill(target, source, ["k"], ["v"]), "k", "v") == [(1, 1.0), (2, 2.0), (3, None)]


def test_annotate_and_set_where(spark, target):
    sums = spark.createDataFrame([(1, 4)], "k int, n int")
    assert rows(merge.annotate(target, sums, ["k"], ["n"]), "k", "n") == [(1, 4), (2, None), (3, None)]
    done = merge.set_where(target, F.col("v") > 1, t=F.lit("big"), extra=F.lit(1))
    assert rows(done, "k", "t", "extra") == [(1, "a", None), (2, "big", 1), (3, "c", None)]


def test_pivot_takes_one_pass(spark):
    eav = spark.createDataFrame([(1, 2, "On"), (1, 3, "7"), (2, 3, "x"), (2, 9, "z")], "id int, kind int, value string")
    wide = joins.pivot_attributes(eav, "id", {"flag": 2, "number": 3}, "kind")
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows(wide) == [(1, "On", "7"), (2, None, "x")]


def test_calendar_strict(spark):
    calendar = spark.createDataFrame([(7, 2009, 1, 1)], "calendar_id bigint, year int, month_numeric int, day_of_month int")
    frame = spark.createDataFrame([(1, datetime(2009, 1, 1, 23)), (2, None)], "k int, t timestamp_ntz")
    assert rows(joins.calendar_lookup(frame, calendar, {"c": "t"}, strict=True), "k", "c") == [(1, 7), (2, None)]
    late = frame.withColumn("t", F.lit(DAY[9]).cast("timestamp_ntz"))
    assert rows(joins.calendar_lookup(late, calendar, {"c": "t"}), "k", "c") == [(1, None), (2, None)]
    with pytest.raises(PySparkException):
        joins.calendar_lookup(late, calendar, {"c": "t"}, strict=True).collect()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_range_join_of_a_minute_and_of_500_years(spark, how):
    """Short and open-ended spans in one table, against all pairs; no span takes more than a few rows."""
    rng = random.Random(12)
    day = lambda d, s=0: datetime(1900, 1, 1) + timedelta(days=d, seconds=s)
    spans = [("minute", k % 3, day(100 * k), day(100 * k, 60)) for k in range(200)]
    spans += [("year", k % 3, day(365 * k), day(365 * k + 364)) for k in range(60)]
    spans += [("era", 0, datetime(1700, 1, 1), datetime(2200, 1, 1)), ("open", 1, day(5000), datetime(9999, 12, 31)), ("none", 1, day(9), day(8)), ("null", 1, None, day(8))]
    points = [(i, rng.randrange(3), day(100 * rng.randrange(250), rng.choice([0, 30, 60, 61]))) for i in range(300)] + [(-1, 0, None), (-2, 5, day(4))]
    found = joins.range_join(
        spark.createDataFrame(points, "i int, g int, t timestamp_ntz"), spark.createDataFrame(spans, "name string, g int, a timestamp_ntz, b timestamp_ntz"),
        "t", "a", "b", on=["g"], how=how,
    )
    expected = []
    for i, g, t in points:
        hits = [(i, name) for name, h, a, b in spans if t and a and g == h and a <= t <= b]
        expected += hits or ([(i, None)] if how == "left" else [])
    assert sorted(rows(found, "i", "name"), key=repr) == sorted(expected, key=repr)


def test_range_join_bounds(spark):
    spans = spark.createDataFrame(
        [(1, datetime(2009, 1, 10), datetime(2009, 3, 5)), (2, datetime(2009, 3, 6), datetime(2009, 3, 6)), (3, DAY[5], DAY[2])],
        "s int, a timestamp_ntz, b timestamp_ntz",
    )
    dates = [datetime(2009, 1, 9), datetime(2009, 1, 10), datetime(2009, 2, 1), datetime(2009, 3, 5), datetime(2009, 3, 6), datetime(2009, 3, 7), None]
    points = spark.createDataFrame(list(enumerate(dates)), "p int, t timestamp_ntz")
    found = joins.range_join(points, spans, "t", "a", "b")
    assert rows(found, "p", "s") == [(0, None), (1, 1), (2, 1), (3, 1), (4, 2), (5, None), (6, None)]
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_outer_conditions_keep_rows(spark, target):
    side = spark.createDataFrame([(1, 5), (2, -1)], "k int, x int")
    assert rows(joins.left_where(target, side, ["k"], F.col("x") > 0), "k", "x") == [(1, 5), (2, None), (3, None)]
    nulls = spark.createDataFrame([(1,), (None,)], "z int")
    assert rows(joins.excluding(target, nulls, {"k": "z"}), "k") == [(2,), (3,)]
    assert rows(joins.excluding(target, nulls, {"k": "z"}, null_aware=True), "k") == []
    assert rows(joins.exists_flag(target, nulls.withColumnRenamed("z", "k"), ["k"], "f"), "k", "f") == [(1, 1), (2, 0), (3, 0)]


def test_payment_costs(spark):
    payments = spark.createDataFrame([(1, 11), (2, 12), (3, 13), (4, 14)], "payment_id int, most_recent_detail_id int")
    details = spark.createDataFrame(
        [(11, None, 100, 6, 53, 1, 10.0), (12, 1, None, 24, 53, 1, 5.0), (13, 1, None, 6, 65, 1, 99.0), (14, None, 100, 6, 53, 2, 77.0),
         (10, None, 100, 6, 53, 1, 1000.0)],
        "payment_detail_id int, parent_payment_id int, component_project_id int, payment_type_id int, payment_status_id int, "
        "installment_number int, total_amount double",
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)"))
    costs = aggregates.payment_costs(payments, details, {"total": None, "prizes": fixed.PRIZE_PAYMENTS, "extra": (24,)})
    assert [tuple(map(float, r)) for r in costs.collect()] == [(100.0, 15.0, 10.0, 5.0)]


def test_tri_state(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (2, "Succeeded"), (2, None), (3, "Failed")], "k int, e string")
    counted = frame.groupBy("k").agg(aggregates.tri_state_count(F.col("e").isNotNull(), F.col("e") == "Succeeded").alias("n"))
    assert rows(counted) == [(1, None), (2, 1), (3, 0)]


def test_rankings_that_look_at_all_results(spark):
    """Best two results of a user, and a user's share of the contest's points."""
    scoring.contest_ranking("best_two", ordered=True)(lambda points, factor: F.when(F.col("nth") <= 2, points).otherwise(0))
    scoring.contest_ranking("share", finish=lambda mine, whole: F.try_divide(100 * mine, whole).cast("decimal(18,2)"))(lambda points, factor: points)
    try:
        rng = random.Random(2)
        data = [(c, rng.randrange(6), rng.randrange(1, 4), float(rng.randrange(100))) for c in (1, 2) for _ in range(60)]
        frame = spark.createDataFrame(data, "contest_id int, user_id int, placed int, final_points double").withColumns(
            {"points_awarded": F.col("final_points"), "potential_points": F.lit(0.0)}
        )
        prizes = spark.createDataFrame([(1, 1, 50)], "contest_id int, place int, prize_amount int")
        by_user = {}
        for c, u, _, p in data:
            by_user.setdefault((c, u), []).append(p)
        best = {(r.contest_id, r.user_id): float(r.final_points) for r in scoring.rank_contests(frame, prizes, "best_two").collect()}
        assert best == {k: sum(sorted(v)[-2:]) for k, v in by_user.items()}
        shares = {(r.contest_id, r.user_id): float(r.final_points) for r in scoring.rank_contests(frame, prizes, "share").collect()}
        whole = {c: sum(p for d, _, _, p in data if d == c) for c in (1, 2)}
        assert shares == {k: pytest.approx(100 * sum(v) / whole[k[0]], abs=0.006) for k, v in by_user.items()}
        mixed = scoring.rank_contests(frame, prizes, F.when(F.col("contest_id") == 1, "best_two").otherwise("points")).collect()
        assert {(r.contest_id, r.user_id): float(r.final_points) for r in mixed} == {k: sum(sorted(v)[-2:]) if k[0] == 1 else sum(v) for k, v in by_user.items()}
    finally:
        scoring._rankings.pop("best_two"), scoring._rankings.pop("share")


def test_contest_ranking(spark):
    results = spark.createDataFrame(
        [(1, 10, 1, 5.0), (1, 11, 2, 9.0), (1, 12, 3, 9.0), (1, 13, 4, 0.0), (1, 10, 2, 3.0)], "contest_id int, user_id int, placed int, p double"
    ).withColumns({"points_awarded": F.col("p"), "final_points": F.col("p"), "potential_points": F.lit(0.0)})
    prizes = spark.createDataFrame([(1, 1, 100.0), (1, 2, 50.0), (1, 3, 20.0), (1, 4, 10.0)], "contest_id int, place int, prize_amount double")
    ranked = scoring.rank_contests(results, prizes)
    assert rows(ranked, "user_id", "current_place", "current_prize") == [(10, 3, 20.0), (11, 1, 100.0), (12, 1, 100.0), (13, 4, None)]
    top = scoring.rank_contests(results, prizes, "top_performers", 2.0)
    assert rows(top, "user_id", "current_place") == [(10, 1), (11, 2), (12, 2), (13, 4)]


def test_calculator_registry(spark):
    @scoring.points_calculator("test_flat")
    def flat():
        return F.lit(7.0), F.lit(3.0)

    frame = spark.createDataFrame(
        [(7, 1, 1, 0, 100.0, 3, "test_flat"), (1, 1, 1, 0, 100.0, 3, "test_flat"), (7, 1, 1, 2, 100.0, 1, None)],
        "project_status_id int, valid_submission_ind int, placed int, point_adjustment int, amount double, num_submissions_passed_review int, calculator string",
    )
    scored = scoring.score_results(frame)
    assert rows(scored, "points_awarded", "final_points", "potential_points") == [(0.0, 0.0, 3.0), (100.0, 102.0, 0.0), (7.0, 7.0, 0.0)]
    scoring._points.pop("test_flat")


def test_warehouse_tables(spark, tmp_path, target):
    house = Warehouse(spark, str(tmp_path / "house"), {"t": target.schema})
    assert house.table("t").count() == 0 and not house.exists("t")
    house.write("t", target)
    house.write("t", merge.delete_keys(house.table("t"), spark.createDataFrame([(1,)], "k int"), "k"))
    assert rows(house.table("t"), "k") == [(2,), (3,)]
    house.write("t", target.limit(1), "append")
    assert house.table("t").count() == 3
    (tmp_path / "house" / "_staged_t-of-a-crash").mkdir()
    assert house.table("t").count() == 3
    with pytest.raises(LookupError):
        house.table("unknown")


def test_staged_rows_show_after_the_commit(spark, tmp_path, target):
    house = Warehouse(spark, str(tmp_path), {"t": target.schema}, {"t": (["k"], 4)})
    house.write("t", target)
    staged = house.stage("t", house.table("t").filter("k <> 1"), touched=spark.createDataFrame([(1,)], "k int"))
    assert house.table("t").count() == 3
    house.commit(staged)
    assert rows(house.table("t"), "k") == [(2,), (3,)]
    with pytest.raises(PySparkException):
        house.write("t", house.table("t").withColumn("k", F.raise_error(F.lit("broken")).cast("int")))
    assert rows(house.table("t"), "k") == [(2,), (3,)]


def test_a_swap_cut_short(spark, tmp_path, target):
    """The old folder was set aside, the new one is not in place yet."""
    house = Warehouse(spark, str(tmp_path), {"t": target.schema})
    house.write("t", target)
    (tmp_path / "t").rename(tmp_path / "_old_t")
    assert house.table("t").count() == 3
    house.write("t", house.table("t").filter("k = 2"))
    assert rows(house.table("t"), "k") == [(2,)] and not (tmp_path / "_old_t").exists()


def test_buckets_of_touched_keys_are_rewritten(spark, tmp_path):
    frame = lambda pairs: spark.createDataFrame(pairs, "k int, v string")
    house = Warehouse(spark, str(tmp_path), buckets={"t": (["k"], 8)})
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").glob("_bucket=*/*.parquet")}
    state = {k: "a" for k in range(100)}
    assert house.write("t", frame(list(state.items())), touched=frame([(1, "")]))
    assert len(list((tmp_path / "t").glob("_bucket=*"))) == 8
    for step in range(5):
        before = files()
        changed = frame([(step, f"s{step}")])
        gone = frame([(50 + step, "")])
        touched = changed.unionByName(gone)
        near = house.near("t", touched)
        # Only the buckets of the two keys are read; rows of others are not needed for the merge.
        assert near.count() < 50
        assert house.write("t", merge.delete_keys(merge.upsert(near, changed, ["k"]), gone, "k"), touched=touched)
        state[step] = f"s{step}"
        state.pop(50 + step)
        assert dict(rows(house.table("t"))) == state
        kept = {p.rsplit("/", 2)[1] for p in before.keys() & files().keys()}
        assert len(kept) >= 6
    assert not house.write("t", frame([]), touched=frame([]))
    house.write("t", frame([(7, "more")]), "append")
    assert sorted(rows(house.table("t"))) == sorted([*state.items(), (7, "more")])
    # All rows of the touched buckets are gone: their folders go too.
    everything = frame([(k, "") for k in range(100)])
    house.write("t", frame([(1, "only")]), touched=everything)
    assert rows(house.table("t")) == [(1, "only")]


def test_merges_prune_to_the_touched_buckets(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), {"t": "k int, v string"}, {"t": (["k"], 16)})
    house.write("t", spark.range(1000).selectExpr("CAST(id AS int) AS k", "'a' AS v"))
    changed = spark.createDataFrame([(5, "b")], "k int, v string")
    merged = merge.upsert(house.near("t", changed), changed, ["k"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "Scan parquet" in line and "_bucket" in line)
    assert "_bucket#" in scan.split("PartitionFilters: [")[1] and merged.count() < 200



def test_sources(spark, tmp_path, target):
    for fmt in ("parquet", "orc", "json", "csv"):
        path = str(tmp_path / fmt)
        write_table(target, path, fmt=fmt)
        assert rows(read_table(spark, path, fmt, schema=target.schema)) == rows(target)
    parts = str(tmp_path / "parts")
    write_table(target, parts, "replace_partitions", ["k"])
    write_table(target.filter("k = 2").withColumn("t", F.lit("new")), parts, "replace_partitions", ["k"])
    assert rows(read_table(spark, parts), "k", "t") == [(1, "a"), (2, "new"), (3, "c")]
    source = Source(spark, "one").add("one", lambda name: target).add("two", lambda name: target.filter("k = 1"))
    source.register("one.t", "two.t")
    assert spark.sql("SELECT a.k FROM one__t a JOIN two__t b ON a.k = b.k").count() == 1
    assert source.table("t").count() == 3 and source.table("two.t").count() == 1


def test_report(spark, target):
    watched = report.LoadReport("t")
    watched.watch(target).write.format("noop").mode("overwrite").save()
    assert watched.finish().rows == 3 and "3 records of t" in str(watched)


def test_unknown_calculator_fails(spark):
    results = spark.createDataFrame(
        [(1, 2, 1, 10.0, 10.0, 10.0, "no_such")],
        "contest_id int, user_id int, placed int, points_awarded double, final_points double, potential_points double, ranking string",
    )
    prizes = spark.createDataFrame([], "contest_id int, place int, prize_amount double")
    with pytest.raises(Exception, match="no_such"):
        scoring.rank_contests(results, prizes, F.col("ranking")).collect()


def test_spans_with_points_against_pairs(spark):
    rng = random.Random(3)
    moment = lambda: DAY[0] + timedelta(hours=rng.randrange(600))
    spans = []
    for i in range(60):
        at = moment()
        spans.append((i % 50, at, at + timedelta(hours=rng.choice([-3, 0, 0, 1, 5]))))
    spans += [(70, None, DAY[20]), (71, DAY[0], None), (None, DAY[0], DAY[27])]
    points = [moment() for _ in range(40)] + [None]
    frames = spark.createDataFrame(spans, "id int, lo timestamp_ntz, hi timestamp_ntz"), spark.createDataFrame([(p,) for p in points], "p timestamp_ntz")
    found = joins.spans_with_points(*frames, "p", "lo", "hi")
    wanted = {s for s in spans if s[1] and s[2] and any(p and s[1] <= p <= s[2] for p in points)}
    assert rows(found) == sorted(wanted, key=repr)


def test_rows_without_a_parent_are_not_joined_in_one_task(spark):
    points = spark.range(400).select(
        "id", F.when(F.col("id") % 50 == 0, F.col("id") + 1).alias("up"), F.col("id").cast("decimal(10,2)").alias("amount")
    )
    found = joins.parent_value(points, "id", "up", "amount", "above", F.col("id") % 100 == 0)
    assert {r.id: r.above for r in found.collect()} == {i: i + 1 if i % 100 == 0 else 0 for i in range(400)}
    # What points nowhere goes past the join.
    assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()


def test_an_older_state_is_loaded_once_and_shared_tables_too(spark, sf_dir, monkeypatch):
    from loadstone.catalog import jobs, world

    asked, settled = [], []
    plain = world.settle
    monkeypatch.setattr(world, "settle", lambda df: settled.append(1) or plain(df))
    state = lambda spark, folder, views: asked.append(1) or spark.range(3)
    ctx = jobs.context(spark, sf_dir, jobs.MARK, {"appeal": state}, jobs.CLOSED)
    assert ctx.target("appeal").count() == ctx.target("appeal").count() == 3
    for name in ("upload", "submission", "review"):
        assert ctx.source(name).count() == world.spark_table(spark, sf_dir, f"src_{name}").count()
    assert asked == [1] and settled == [1]


def test_reviews_are_not_sought_first_where_many_changed(spark, sf_dir, monkeypatch):
    from loadstone.catalog import jobs
    from loadstone.plans import all_loads, core

    ctx = jobs.context(spark, sf_dir, jobs.MARK, {}, jobs.CLOSED)
    assert core.touched_reviews(ctx) is None
    columns = ["project_id", "user_id", "scorecard_id"]
    once = rows(all_loads()["submission_screening"].run(ctx)["submission_screening"].rows, *columns)
    monkeypatch.setattr(core, "MANY_LATE", 1)
    assert core.touched_reviews(ctx) is not None
    assert once and once == rows(all_loads()["submission_screening"].run(ctx)["submission_screening"].rows, *columns)


def test_results_are_exchanged_by_project_and_user_only(spark, sf_dir):
    from loadstone.catalog import jobs
    from loadstone.plans.results import result_rows

    ctx = jobs.context(spark, sf_dir, jobs.MARK, {}, jobs.CLOSED)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = result_rows(ctx, ctx.source("project").select("project_id"))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(project_id" in line and "user_id" in line]
    # Results, what was entered, inquiries, reliability: one exchange each, none for the row of a user that is kept.
    assert len(exchanges) == 4


def test_only_repeated_keys_are_grouped(spark):
    data = [(1, "a", 5), (2, "b", 1), (2, "c", 2), (None, "d", 1), (None, "e", 1), (3, "f", None), (3, "f", None), (4, None, 0)]
    changes = spark.createDataFrame(data, "k int, v string, at int")
    for frame in (changes, changes.filter("k IN (1, 4)"), changes.filter("k > 9")):
        assert rows(merge.last_per_settled(frame, ["k"], ["at"])) == rows(merge.last_per_key(frame, ["k"], ["at"]))
        assert rows(merge.last_per_settled(frame, ["k", "v", "at"])) == rows(merge.last_per_key(frame, ["k", "v", "at"]))
    alone = merge.last_per_settled(changes.filter("k = 1"), ["k"])
    assert "Aggregate" not in alone._jdf.queryExecution().optimizedPlan().toString()


def test_a_review_row_carries_flags_instead_of_stamps(spark, sf_dir):
    from loadstone.catalog import jobs
    from loadstone.plans.core import reviews

    ctx = jobs.context(spark, sf_dir, jobs.MARK, {}, jobs.CLOSED)
    found = reviews(ctx, (4, 5, 6, 7))
    assert {c for c in found.columns if c[:2] in ("m_", "w_")} == set()
    assert {dict(found.dtypes)[c] for c in found.columns if c[:2] == "c_"} == {"boolean"}


def test_children_are_grouped_table_by_table(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id bigint")
    texts = spark.createDataFrame([(1, "a"), (1, "b"), (3, None), (None, "z")], "id bigint, text string")
    sums = spark.createDataFrame([(1, 5), (2, 7), (2, 8), (9, 1)], "id bigint, amount bigint")
    parts = {
        "text": (texts, {"last": F.max("text"), "texts": F.count("text")}),
        "sum": (sums, {"total": F.sum("amount")}),
    }
    children = aggregates.join_children(parents, parts, "id", zero=["texts"])
    # A parent named twice gives one row, one without children none; a child that holds nothing is one.
    assert rows(children) == [(1, "b", 2, 5), (2, None, 0, 15), (3, None, 0, None)]
    # No aggregate is as wide as all child tables together.
    plan = children._jdf.queryExecution().optimizedPlan().toString()
    assert not any("amount" in line and "text" in line for line in plan.splitlines() if "Aggregate" in line)
    assert "Union" not in plan


def test_people_are_looked_up_with_the_ids_alone(spark):
    users = spark.createDataFrame([(7,), (8,)], "user_id bigint")
    context = LoadContext(lambda name: {"common.user": users}[name], lambda name: None, None, DAY[0])
    frame = spark.createDataFrame([(1, 7, 9), (2, None, 8)], "project_id bigint, a bigint, b bigint")
    assert rows(people(context, frame, {"first": "a", "second": "b"}), "project_id", "first", "second") == [(1, 7, None), (2, None, 8)]


def test_contests_alike_are_ranked_once(spark):
    contests = spark.createDataFrame(
        [(5, 1, "points"), (3, 1, "points"), (4, 1, "top_performers"), (8, 2, "points"), (9, 1, "points"), (9, 1, "points"), (None, 2, "points")],
        "contest_id bigint, track_id bigint, ranking string",
    )
    alike = scoring.alike_contests(contests, ["track_id", "ranking"])
    assert rows(alike, "contest_id", "like") == sorted([(5, 3), (3, 3), (4, 4), (8, 8), (9, 9), (None, 8)], key=repr)


def test_sieve_passes_every_key_and_few_others(spark):
    keys = settle(spark.range(0, 300_000, 100).select(F.col("id").cast("int").alias("k")).unionByName(spark.createDataFrame([(None,), (0,)], "k int")))
    table = spark.range(0, 300_000).select(F.col("id"), F.col("id").alias("value"))
    passed = joins.Sieve.of(keys).rows(table.unionByName(table.filter("id = 200")), "id")
    assert passed.columns == ["id", "value"]
    assert passed.filter("id % 100 = 0").count() == 3001
    assert passed.filter("id % 100 <> 0").count() < 300_000 * 0.15
    assert joins.Sieve.of(keys.filter("k < 0")).rows(table, "id").count() == 0


def test_touched_matches_are_of_the_given_matches(spark):
    old, new = DAY[0], DAY[20]
    tables = {
        "project": spark.createDataFrame([(1, new), (2, old), (3, old), (4, new), (5, old), (6, old), (None, new)], "project_id bigint, modify_date timestamp_ntz"),
        "project_info": spark.createDataFrame(
            [(2, 1, "20", old, old), (3, 56, "30", old, old), (5, 22, "x", old, new), (6, 56, "60", old, old), (4, 1, "20", old, new)],
            "project_id bigint, project_info_type_id int, value string, create_date timestamp_ntz, modify_date timestamp_ntz",
        ),
        "comp_versions": spark.createDataFrame([(20, new)], "comp_vers_id bigint, modify_date timestamp_ntz"),
        "payment": spark.createDataFrame([(300, old, new), (600, old, old), (None, new, new)], "most_recent_detail_id bigint, create_date timestamp_ntz, modify_date timestamp_ntz"),
        "payment_detail": spark.createDataFrame(
            [(300, 53, 30, old, old), (600, 53, 60, old, old), (600, 65, 60, new, new)],
            "payment_detail_id bigint, payment_status_id int, algorithm_round_id bigint, create_date timestamp_ntz, date_modified timestamp_ntz",
        ),
    }
    context = LoadContext(tables.__getitem__, lambda name: None, DAY[10], DAY[27])
    matches = spark.createDataFrame([(1,), (2,), (2,), (3,), (5,), (6,)], "project_id bigint")
    # By the project, the version, an attribute and a payment of the round; 4 changed, but is no match.
    assert rows(touched_matches(context, matches)) == [(1,), (2,), (3,), (5,)]


def test_a_calendar_is_worked_out_once_per_query(spark, sf_dir):
    views = {}
    assert world.spark_table(spark, sf_dir, "dw_calendar", views).count() == world.spark_table(spark, sf_dir, "dw_calendar").count()
    assert set(views) == {"dw_calendar"}


def test_what_is_settled_on_the_way_goes(spark):
    import os

    from loadstone.session import lasting, settle_alone

    kept = {}
    place = lambda frame: frame.inputFiles()[0].removeprefix("file:").rpartition("/")[0]

    def make():
        kept["way"] = settle(spark.range(50).withColumn("k", F.col("id") % 5))
        with lasting():
            kept["shared"] = settle(spark.range(3))
        kept["way"], kept["shared_at"], frame = place(kept["way"]), place(kept["shared"]), kept["way"]
        return frame.groupBy("k").count()

    found = settle_alone(make)
    assert rows(found) == [(k, 10) for k in range(5)]
    assert not os.path.exists(kept["way"]) and os.path.exists(kept["shared_at"]) and os.path.exists(place(found))
    with pytest.raises(ZeroDivisionError):
        settle_alone(lambda: 1 / 0)


def test_exchanged_files_go_when_rows_are_settled(spark):
    import glob

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [d.getAbsolutePath() for d in manager.localDirs()]
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    frame = spark.range(1000).repartition(7)
    settle(frame)
    for _ in range(50):
        if not (left := files() - before):
            break
        import time

        time.sleep(0.1)
    assert not left
    # Only there: a result that is read twice is not worked out twice.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_rows_pass_by_a_condition_or_a_sieve(spark):
    keys = lambda *ids: joins.Sieve.of(settle(spark.createDataFrame([(i,) for i in ids], "k bigint")))
    table = spark.range(2000).select("id", (F.col("id") * 7).alias("other"), F.when(F.col("id") % 500 == 1, True).alias("own"))
    passed = joins.passing(table, F.col("own"), [("id", keys(3, 4)), ("other", keys(70, 5))])
    ids = [r.id for r in passed.collect()]
    assert passed.columns == table.columns and len(ids) == len(set(ids)) < 2000 * 0.5
    assert {1, 501, 1001, 1501, 3, 4, 10} <= set(ids)


def test_reviews_without_a_change_are_left_out_before_they_are_exchanged(spark, sf_dir):
    from loadstone.catalog import jobs
    from loadstone.plans import core

    ctx = jobs.context(spark, sf_dir, datetime(2001, 6, 1), {}, jobs.CLOSED)
    every = core.reviews(ctx, (4, 5, 6, 7))
    late_items = core.late(ctx, "review_item", "review_id").distinct()
    found = core.reviews(ctx, (4, 5, 6, 7), below=core.changed_below(ctx, "ri"))
    names = [c for c in every.columns]
    wanted = every.filter(core.review_changed()).unionByName(every.join(late_items, "review_id", "left_semi")).distinct()
    assert 0 < wanted.count() and set(rows(wanted, *names)) <= set(rows(found, *names)) <= set(rows(every, *names))
    assert found.count() < every.count()


@pytest.mark.parametrize("many", [1_000_000, 30, 0])
def test_standings_by_pieces_equal_those_of_all_pairs(spark, monkeypatch, many):
    rng = random.Random(many)
    moment = lambda: DAY[0] + timedelta(hours=rng.randrange(500))
    results = [(rng.randrange(3), moment(), rng.randrange(9), rng.choice([1, 2, None]), *(float(rng.randrange(5)) for _ in range(3))) for _ in range(150)]
    results.append((1, None, 1, 1, 5.0, 5.0, 5.0))
    contests = []
    for i in range(12):
        start = moment()
        contests += [(i, k, start, start + timedelta(hours=rng.choice([-1, 0, 30, 400])), rng.choice(["points", "top_performers"]), rng.choice([None, 2.0]))
                     for k in rng.sample(range(3), rng.choice([1, 1, 2]))]
    contests.append(contests[0])
    frame = settle(spark.createDataFrame(
        results, "kind int, at timestamp_ntz, user_id int, placed int, points_awarded double, final_points double, potential_points double"
    ))
    drawn = settle(spark.createDataFrame(contests, "contest_id bigint, kind int, start_date timestamp_ntz, end_date timestamp_ntz, ranking string, factor double"))
    pairs = frame.join(drawn, (frame["kind"] == drawn["kind"]) & frame["at"].between(drawn["start_date"], drawn["end_date"])).drop("kind")
    wanted = scoring.rank_users(pairs, F.col("ranking"), F.col("factor"))
    monkeypatch.setattr(scoring, "MANY_RESULTS", max(many, 1))
    found = scoring.standings(frame, drawn, "at", "kind")
    assert rows(found, *wanted.columns) == rows(wanted) != []
    # Where no contest has many results, pairs are not exchanged: the standings come out of the one exchange of the results.
    if many > 1000:
        assert "RangePartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1


def test_rankings_that_need_more_than_sums_are_exchanged(spark, monkeypatch):
    monkeypatch.setitem(scoring._rankings, "share", scoring.ContestRanking(lambda p, f: p, F.sum, lambda own, whole: F.try_divide(100 * own, whole)))
    assert [r[0] for r in spark.range(1).select(scoring.in_place(F.lit("share"))).collect()] == [False]
    frame = settle(spark.createDataFrame(
        [(1, DAY[3], u, 1, float(u), float(u), 0.0) for u in (1, 3)],
        "kind int, at timestamp_ntz, user_id int, placed int, points_awarded double, final_points double, potential_points double",
    ))
    drawn = settle(spark.createDataFrame(
        [(7, 1, DAY[0], DAY[9], "share", 1.0), (8, 1, DAY[0], DAY[9], "points", 1.0)],
        "contest_id bigint, kind int, start_date timestamp_ntz, end_date timestamp_ntz, ranking string, factor double",
    ))
    found = scoring.standings(frame, drawn, "at", "kind")
    assert {(r.contest_id, r.user_id): (float(r.final_points), r.current_place) for r in found.collect()} == {
        (7, 1): (25.0, 2), (7, 3): (75.0, 1), (8, 1): (1.0, 2), (8, 3): (3.0, 1)}


def test_standings_spread_to_contests_alike_with_their_own_prizes(spark):
    ranked = spark.createDataFrame(
        [(1, 5, 9, 9, 0, 1), (1, 6, 0, 0, 0, 2), (3, 5, 4, 4, 0, 1)],
        "contest_id bigint, user_id bigint, initial_points int, final_points int, potential_points int, current_place bigint",
    )
    alike = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 4)], "contest_id bigint, like bigint")
    prizes = spark.createDataFrame([(1, 1, 10), (1, 1, 20), (2, 2, 30), (2, None, 40), (3, 2, 50)], "contest_id bigint, place int, prize_amount int")
    found = scoring.spread_alike(ranked, alike, prizes)
    assert rows(found, "contest_id", "user_id", "current_place", "current_prize") == sorted(
        [(1, 5, 1, 20), (1, 6, 2, None), (2, 5, 1, None), (2, 6, 2, None), (3, 5, 1, None)], key=repr)


def test_many_changed_keys_are_not_sent_to_all_tasks(spark, monkeypatch):
    target = settle(spark.range(0, 60, 2).select("id", F.col("id").cast("string").alias("v"), F.lit(1).alias("w")))
    changes = settle(spark.range(40).select("id", F.lit("new").alias("v"), F.lit(None).cast("int").alias("w")))
    plan = lambda frame: frame._jdf.queryExecution().sparkPlan().toString()
    partly = changes.drop("w")
    few = [merge.upsert(target, c, ["id"], settled=True) for c in (changes, partly)]
    monkeypatch.setattr(merge, "MANY_KEYS", 39)
    many = [merge.upsert(target, c, ["id"], settled=True) for c in (changes, partly)]
    for a, b in zip(few, many):
        assert "BroadcastHashJoin" in plan(a) and "SortMergeJoin" in plan(b)
        assert rows(a) == rows(b)
    assert "BroadcastHashJoin" not in plan(many[0])


def test_children_in_steps_give_the_same_rows(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id bigint")
    texts = spark.createDataFrame([(1, "a"), (1, "b"), (3, None), (None, "z")], "id bigint, text string")
    sums = spark.createDataFrame([(1, 5), (2, 7), (2, 8), (9, 1)], "id bigint, amount bigint")
    parts = {"text": (texts, {"last": F.max("text"), "texts": F.count("text")}), "sum": (sums, {"total": F.sum("amount")})}
    steps = aggregates.join_children(parents, parts, "id", zero=["texts"], steps=True)
    assert rows(steps) == rows(aggregates.join_children(parents, parts, "id", zero=["texts"]))
    # Only the ids of the parents are still grouped: what comes of the tables is settled.
    plan = steps._jdf.queryExecution().optimizedPlan().toString()
    assert not any("amount" in line or "text" in line for line in plan.splitlines() if "Aggregate" in line)


def test_rows_of_few_replaced_keys_stay_where_they_are(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    target = settle(spark.range(50).select("id", (F.col("id") % 5).alias("k")))
    touched = settle(spark.createDataFrame([(1,), (1,), (None,)], "k bigint"))
    new = spark.createDataFrame([(100, 1)], "id bigint, k bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {few: merge.replace_by_key(target, new, ["k"], touched, few=few) for few in (0, 2, 3)}
        plans = {few: frame._jdf.queryExecution().sparkPlan().toString() for few, frame in found.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert ["BroadcastHashJoin" in plans[few] for few in (0, 2, 3)] == [False, False, True]
    assert rows(found[0]) == rows(found[2]) == rows(found[3]) and found[3].count() == 41
