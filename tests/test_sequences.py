"""Ordered operators: plain windows, split groups and plain Python agree."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadstone.operators import sequences
from loadstone.session import settle


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, the rest over many; a null group too."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        group = 0 if i % 3 == 0 else (None if i % 50 == 1 else rng.randrange(1, 200))
        data.append((group, rng.randrange(10 ** 6), i, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, 900, 1000, 1100, 1200, 1300])))
    return spark.createDataFrame(data, "g int, t int, id int, placed int, rating int").cache()


PIECES = [1, 2, 7, 40]


@pytest.fixture(params=PIECES)
def pieces(spark, request):
    """The same result for any number of pieces: whole groups in one, groups over many."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scan_equals_plain_windows(skewed, pieces):
    got = sequences.scan(
        skewed, ["g"], ["t", "id"], number="n", lags={"before": F.col("placed")},
        sums={"running": F.col("placed")}, totals={"total": F.col("placed")},
    )
    order = Window.partitionBy("g").orderBy("t", "id")
    whole = Window.partitionBy("g")
    plain = skewed.select(
        "g", "id", F.row_number().over(order).alias("n"), F.lag("placed").over(order).alias("before"),
        F.coalesce(F.sum("placed").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("running"),
        F.coalesce(F.sum("placed").over(whole), F.lit(0)).alias("total"),
    )
    names = ["g", "id", "n", "before", "running", "total"]
    assert got.count() == 3000
    assert rows(got, *names) == rows(plain, *names)


def test_runs_and_sums_over_lags(skewed, pieces):
    """Runs and sums whose condition looks at the row before, also where that lies in an earlier piece."""
    changed = ~F.col("placed").eqNullSafe(F.col("before"))
    rises = F.when(F.col("rating") > F.col("rated"), 1)
    got = sequences.scan(
        skewed, ["g"], ["t", "id"], number="n", lags={"before": F.col("placed"), "rated": F.col("rating")},
        runs={"since": changed}, sums={"risen": rises}, totals={"rises": rises},
    )
    order = Window.partitionBy("g").orderBy("t", "id")
    plain = skewed.select(
        "g", "id", F.row_number().over(order).alias("n"), "placed", "rating",
        F.lag("placed").over(order).alias("before"), F.lag("rating").over(order).alias("rated"),
    ).select("*", F.when((F.col("n") == 1) | changed, F.col("n")).alias("begun"), F.coalesce(rises, F.lit(0)).alias("rise"))
    upto, whole = Window.partitionBy("g").orderBy("n").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("g")
    plain = plain.select(
        "*", F.max("begun").over(upto).alias("since"), F.sum("rise").over(upto).alias("risen"), F.sum("rise").over(whole).alias("rises")
    )
    names = ["g", "id", "n", "before", "rated", "since", "risen", "rises"]
    assert rows(got, *names) == rows(plain, *names)


def test_runs_over_many_pieces(spark, pieces):
    """One run longer than a piece, in the only group."""
    frame = spark.createDataFrame([(k, 7 if 50 <= k < 950 else k) for k in range(1000)], "id int, v int")
    got = sequences.scan(frame, [], ["id"], lags={"b": F.col("v")}, runs={"since": F.col("v") != F.col("b")}, number="n")
    expected = [(k, k + 1, 51 if 50 <= k < 950 else k + 1) for k in range(1000)]
    assert rows(got, "id", "n", "since") == sorted(expected, key=repr)


def test_one_range_exchange_and_one_settled_copy(spark, monkeypatch):
    frame = spark.createDataFrame([(u % 5, 112, u, u, u % 3, 1000 + u % 7) for u in range(300)], "user_id int, phase_id int, project_id int, rating_order int, placed int, rating int")
    settled = []
    real = sequences.settle
    monkeypatch.setattr(sequences, "settle", lambda df: settled.append(df) or real(df))
    sequences.streaks(frame).collect()
    assert len(settled) == 1
    plan = settled[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1


def test_no_keys(skewed, pieces):
    numbered = rows(sequences.surrogate_keys(skewed, ["t", "id"], "k", 500), "id", "k")
    expected = sorted(enumerate_from(sorted((t, i) for t, i in rows(skewed, "t", "id")), 501))
    assert sorted(numbered) == expected


def test_keys_by_block(spark, skewed, pieces):
    dealt = skewed.withColumn("p", F.when(F.col("t") < 400000, 0).otherwise(1))
    blocks = sequences.block_keys(dealt.filter("g IS NOT NULL"), ["g", "p"], ["t", "id"], "k", 500)
    whole = sequences.surrogate_keys(skewed.filter("g IS NOT NULL"), ["g", "t", "id"], "k", 500)
    assert rows(blocks, "id", "k") == rows(whole, "id", "k")
    # The rows themselves are not put in order: that would be a range exchange, and one more to hand the pieces on.
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan
    assert sequences.block_keys(dealt.filter("id < 0"), ["g", "p"], ["t"], "k").count() == 0


def enumerate_from(ordered, first):
    return [(row[1], first + k) for k, row in enumerate(ordered)]


def test_descending_order(skewed, pieces):
    got = sequences.scan(skewed, ["g"], [F.col("rating").desc(), "id"], number="n")
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(F.col("rating").desc(), "id")))
    assert rows(got, "id", "n") == rows(plain, "id", "n")


def test_empty_input(skewed):
    none = skewed.filter("id < 0")
    assert sequences.scan(none, ["g"], ["t"], number="n", totals={"s": F.col("placed")}).count() == 0
    assert sequences.surrogate_keys(none, ["t"], "k").count() == 0


def test_ranks_with_ties(spark):
    data = [("a", 1, 10), ("a", 2, 10), ("a", 3, 5), ("a", 4, 1), (None, 5, 3), (None, 6, 3), ("b", 7, 0)]
    frame = spark.createDataFrame(data, "g string, u int, r int")
    ranked = sequences.rank_with_ties(frame, ["g"], "r", size="size", percentile="p")
    assert rows(ranked, "u", "rank", "size", "p") == [
        (1, 1, 4, 75.0), (2, 1, 4, 75.0), (3, 3, 4, 25.0), (4, 4, 4, 0.0), (5, 1, 2, 50.0), (6, 1, 2, 50.0), (7, 1, 1, 0.0),
    ]


def test_rating_ranks(spark, pieces):
    rng = random.Random(3)
    data = [(i, rng.randrange(40), rng.choice([112, 112, 113]), rng.choice([0, 1])) for i in range(800)]
    frame = spark.createDataFrame(data, "user_id int, rating int, phase_id int, active int")
    names = ["user_id", "user_rank_type_id", "rank", "rank_no_tie", "percentile"]
    plain = rows(sequences.rating_ranks(frame, ["phase_id"], position="rank_no_tie"), *names)
    for kind in (1, 2):
        for phase in (112, 113):
            members = [(u, r) for u, r, p, a in data if p == phase and (kind == 1 or a)]
            for user, rating in members:
                better = sum(r > rating for _, r in members)
                place = 1 + better + sum(r == rating and u < user for u, r in members)
                share = round(100 * (len(members) - better - 1) / len(members), 4)
                assert (user, kind, better + 1, place, share) in plain


def state_machine(data, accept):
    """Streaks of one kind the plain way: walk each user's results in order."""
    found = []
    for (user, phase), results in data.items():
        run, before, first = [], None, True
        for project, placed, rating in results:
            if accept(placed or 0, rating or 0, before, first):
                run.append(project)
            else:
                if len(run) > 1:
                    found.append((user, phase, run[0], run[-1], len(run), 0))
                run = []
            before, first = rating or 0, False
        if len(run) > 1:
            found.append((user, phase, run[0], run[-1], len(run), 1))
    return found


KINDS = {
    1: lambda placed, rating, before, first: placed == 1,
    2: lambda placed, rating, before, first: placed in (1, 2),
    3: lambda placed, rating, before, first: not first and rating > before,
    4: lambda placed, rating, before, first: not first and rating < before,
}


def test_streaks_equal_state_machine(spark, pieces):
    rng = random.Random(11)
    data, table = defaultdict(list), []
    for project in range(1500):
        user = 0 if project % 3 == 0 else rng.randrange(1, 30)
        phase, placed, rating = rng.choice([112, 113]), rng.choice([None, 1, 1, 2, 3]), rng.choice([None, 900, 1000, 1100, 1200])
        data[user, phase].append((project, placed, rating))
        table.append((user, phase, project, project, placed, rating))
    frame = spark.createDataFrame(table, "user_id int, phase_id int, project_id int, rating_order int, placed int, rating int")
    got = rows(
        sequences.streaks(frame),
        "streak_type_id", "user_id", "phase_id", "start_project_id", "end_project_id", "length", "is_current",
    )
    expected = sorted(((kind, *row) for kind, accept in KINDS.items() for row in state_machine(data, accept)), key=repr)
    assert got == expected


def test_prior_count_of_undated_rows(spark):
    data = [(1, 10, None, 1), (1, 11, 5, 1), (1, 12, 5, 0), (1, 13, 4, 1), (2, 14, 1, 0)]
    frame = spark.createDataFrame(data, "u int, p int, d int, rated int")
    counted = sequences.prior_count(frame, ["u"], ["d", "p"], F.col("rated") == 1, "n")
    assert rows(counted, "p", "n") == [(10, 1), (11, 2), (12, 2), (13, 1), (14, 0)]


def test_slots(spark):
    data = [(1, 5, 2), (1, 6, 4), (1, 7, 4), (1, 7, 1), (1, 8, 4), (2, 6, 4)]
    frame = spark.createDataFrame(data, "p int, r int, s int")
    assert rows(sequences.assign_slots(frame, "p", "r", "s"), "p", "r", "s") == [(1, 5, 2), (1, 6, 4), (1, 7, 1), (1, 8, 5), (2, 6, 4)]


def test_place_gaps(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 3)], "c int, place int")
    assert rows(sequences.place_gaps(frame, ["c"], "place"), "c", "place", "gap") == [(1, 1, 0), (1, 2, 0), (2, 1, 0), (2, 3, 1)]


def test_blocks_are_numbered_where_they_are(spark, monkeypatch):
    rows = settle(spark.range(200).select("id", (F.col("id") % 7).alias("track"), (F.col("id") % 3).cast("int").alias("part")))
    dealt = rows.repartitionById(3, "part")
    found = sequences.block_keys(dealt, ["track", "part"], ["id"], "k", 9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    expected = sorted((i % 7, i % 3, i) for i in range(200))
    assert sorted((r.k, r.id) for r in found.collect()) == [(10 + n, i) for n, (_, _, i) in enumerate(expected)]
    monkeypatch.setattr(sequences, "FEW_BLOCKS", 0)
    again = sequences.block_keys(dealt, ["track", "part"], ["id"], "k", 9)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
