"""Pluggable scoring of contest results.

Contests name their calculator in a table row. A calculator here is a function
that builds columns or DataFrames, looked up by that name, so a contest of any
size is ranked by Spark and never handed to one Python call.

The formulas below are defaults of this library: the systems whose loads these
are name calculators but publish none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstone.functions.scalar import placement_points, taxable_share
from loadstone.operators.joins import range_join
from loadstone.operators.sequences import rank_with_ties, scan
from loadstone.session import settle

ResultPoints = Callable[[], tuple[Column, Column]]


@dataclass(frozen=True)
class ContestRanking:
    """How a contest's results become a user's points, in three steps that Spark can spread.

    ``row(points, factor)``: what a result is worth. It may use the result's columns and, if ``ordered``, ``nth``: the
    place of the result among the user's in the contest, best first. ``merge(worth)``: aggregate over a user's results, combined on
    the map side. ``finish(points, contest)``: the user's points, given the ``merge`` of all results of the contest.
    """

    row: Callable[[Column, Column], Column]
    merge: Callable[[Column], Column]
    finish: Callable[[Column, Column], Column] | None = None
    ordered: bool = False


_points: dict[str, ResultPoints] = {}
_rankings: dict[str, ContestRanking] = {}


def points_calculator(name: str):
    """Register a function that gives (awarded, potential) point columns of a result row."""
    def register(function: ResultPoints) -> ResultPoints:
        _points[name] = function
        return function
    return register


def contest_ranking(name: str, merge: Callable[[Column], Column] = F.sum, finish=None, ordered: bool = False):
    """Register a function as the ``row`` step of a ranking; the other steps are given here."""
    def register(function: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
        _rankings[name] = ContestRanking(function, merge, finish, ordered)
        return function
    return register


def by_place(place: str = "placed") -> list[Column]:
    return [F.col(place).asc()]


def by_score(score: str = "final_score") -> list[Column]:
    return [F.col(score).desc()]


@points_calculator("placement")
def placement_calculator() -> tuple[Column, Column]:
    """Share of the amount by place; an open project's best case is the first place."""
    awarded = placement_points(F.col("amount").cast("double"), F.col("num_submissions_passed_review"), F.col("placed"))
    potential = placement_points(F.col("amount").cast("double"), F.col("num_submissions_passed_review"), F.lit(1))
    return awarded, potential


@points_calculator("winner_takes_all")
def winner_calculator() -> tuple[Column, Column]:
    amount = F.coalesce(F.col("amount").cast("double"), F.lit(0.0))
    return F.when(F.col("placed") == 1, amount).otherwise(0.0), amount


def _by_name(name: Column, values: dict[str, Column]) -> Column:
    """The value registered under a name; an unknown name fails the job."""
    chosen = F
    for key, value in values.items():
        chosen = chosen.when(name == key, value)
    return chosen.otherwise(F.raise_error(F.concat(F.lit("no calculator is registered as "), F.coalesce(name, F.lit("null")))))


def score_results(results: DataFrame, calculator: str = "calculator", default: str = "placement") -> DataFrame:
    """Add points_awarded, final_points and potential_points by the calculator each row names.

    Closed projects (states 7 and 8) earn points plus their adjustment; open
    ones with a valid submission have potential points. A calculator that is
    not registered fails the job with its name.
    """
    closed = F.col("project_status_id").isin(7, 8)
    open_valid = ~closed & (F.coalesce(F.col("valid_submission_ind"), F.lit(0)) == 1)
    name = F.coalesce(F.col(calculator), F.lit(default))
    pairs = {key: build() for key, build in _points.items()}
    awarded = _by_name(name, {key: gain for key, (gain, _) in pairs.items()})
    potential = _by_name(name, {key: best for key, (_, best) in pairs.items()})
    adjustment = F.coalesce(F.col("point_adjustment"), F.lit(0))
    return results.withColumns({
        "points_awarded": F.when(closed, awarded).otherwise(0.0),
        "potential_points": F.when(open_valid, potential).otherwise(0.0),
    }).withColumn("final_points", F.col("points_awarded") + adjustment)


@contest_ranking("points")
def every_point(points: Column, factor: Column) -> Column:
    """Each user's points are the sum over the contest's results."""
    return points


@contest_ranking("top_performers")
def first_places(points: Column, factor: Column) -> Column:
    """As ``points``, with first places counted ``factor`` times."""
    return F.when(F.col("placed") == 1, points * factor).otherwise(points)


def _plain(name: str) -> bool:
    return not _rankings[name].ordered and _rankings[name].finish is None


def in_place(ranking: Column) -> Column:
    """True for names of rankings that need no order among a user's results and no total of the contest, and for unknown names."""
    return ~F.coalesce(ranking.isin(*[name for name in _rankings if not _plain(name)]), F.lit(False))


def rank_users(
    results: DataFrame, calculator: Column | str = "points", factor: Column | float = 1.0, piece: str | None = None
) -> DataFrame:
    """Points and place per contest and user; see ``rank_contests``.

    ``piece`` is the column by which the rows are partitioned, where all results of a contest are in one piece and all rankings
    are such as ``in_place`` names: nothing is exchanged then.
    """
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    fixed_name = calculator if isinstance(calculator, str) else None
    used = _rankings if fixed_name is None else {fixed_name: _rankings[fixed_name]} if fixed_name in _rankings else _rankings
    if piece:
        used = {name: ranking for name, ranking in used.items() if _plain(name)}
    sums = {"points_awarded": "initial_points", "final_points": "final_points", "potential_points": "potential_points"}
    sums |= {c: c for c in ("taxable_points",) if c in results.columns}
    rows = results.withColumns({"_how": F.lit(calculator) if fixed_name else calculator, "_factor": factor})
    if any(ranking.ordered for ranking in used.values()):
        rows = scan(rows, ["contest_id", "user_id"], [F.col("final_points").desc(), F.xxhash64(*results.columns)], number="nth")
    money = "decimal(18,2)"
    worth = lambda column, name: (
        F.when(F.col("_how") == name, used[name].row(F.col(column), F.col("_factor")).cast(money))
    )
    partial = [used[name].merge(worth(column, name)).alias(f"{as_name}:{name}") for column, as_name in sums.items() for name in used]
    per_user = rows.groupBy(*([piece] if piece else []), "contest_id", "user_id", "_how").agg(*partial)
    finishing = [name for name, ranking in used.items() if ranking.finish]
    if finishing:
        # One row per contest, from the same partial aggregates over all its results.
        whole = rows.groupBy(F.col("contest_id").alias("_contest")).agg(
            *[used[name].merge(worth(column, name)).alias(f"all:{as_name}:{name}") for column, as_name in sums.items() for name in finishing]
        )
        per_user = per_user.join(whole, F.col("contest_id") == F.col("_contest"), "left")
    done = lambda name, as_name: (
        F.col(f"{as_name}:{name}") if name not in finishing
        else used[name].finish(F.col(f"{as_name}:{name}"), F.col(f"all:{as_name}:{name}"))
    )
    totals = per_user.select(
        *([piece] if piece else []), "contest_id", "user_id",
        *[_by_name(F.col("_how"), {name: done(name, as_name) for name in used}).alias(as_name) for as_name in sums.values()]
    )
    if piece:
        place = F.rank().over(Window.partitionBy(piece, "contest_id").orderBy(F.col("final_points").desc()))
        return totals.withColumn("current_place", place.cast("bigint")).drop(piece)
    return rank_with_ties(totals, ["contest_id"], "final_points", rank="current_place")


# Results of a contest above which its standings are worked out by exchanges, and share of results of a task below that.
MANY_RESULTS = 2_000_000
# Rows of contests up to which they are sent to all tasks.
FEW_CONTESTS = 500_000


def standings(results: DataFrame, contests: DataFrame, moment: str, on: str) -> DataFrame:
    """Points and place per user of every contest; a contest draws on the results of its time and kind.

    ``results`` are settled, with the ``moment`` and the kind (``on``) of each; ``contests`` are settled rows of contest_id, start_date,
    end_date, kind, ranking and factor. The results of a contest overlap with those of many others, so there are
    far more pairs of contest and result than rows: contests are dealt to pieces of about equal work, by kind and start, and a piece
    gets the results of its time span once, so no pair is exchanged. Contests of very many results and rankings
    that need more than sums are worked out by exchanges.
    """
    spark, span = results.sparkSession, ["start_date", "end_date"]
    day = lambda column: F.date_trunc("day", column).cast("timestamp_ntz")
    days = settle(results.groupBy(on, day(moment).alias("_day")).agg(F.count(F.lit(1)).alias("_results")))
    near = contests.select("contest_id", on, day("start_date").alias("_from"), F.col("end_date").alias("_to"))
    sizes = range_join(days, near, "_day", "_from", "_to", on=[on], how="inner").groupBy("contest_id").agg(F.sum("_results").alias("_results"))
    plain = contests.groupBy("contest_id").agg(
        F.min(F.struct(on, "start_date")).alias("_at"), F.min(in_place(F.col("ranking")).cast("int")).alias("_plain")
    )
    sizes = settle(plain.join(sizes, "contest_id"))
    few = F.lit(contests.count() <= FEW_CONTESTS) & (F.col("_results") <= MANY_RESULTS) & (F.col("_plain") == 1)
    dealt = sizes.filter(few)
    whole = dealt.agg(F.coalesce(F.sum("_results"), F.lit(0))).first()[0]
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(whole) // MANY_RESULTS))
    through = scan(dealt.select("contest_id", "_at.*", "_results"), [], [on, "start_date", "contest_id"], sums={"_through": F.col("_results")})
    piece = F.floor((F.col("_through") - F.col("_results")) * pieces / F.lit(max(1, int(whole)))).cast("int")
    draws = settle(contests.join(through.select("contest_id", F.least(piece, F.lit(pieces - 1)).alias("_piece")), "contest_id"))
    hulls = settle(draws.groupBy("_piece", on).agg(F.min("start_date").alias("_lo"), F.max("end_date").alias("_hi")))
    of_kind = lambda a, b: a[on] == b[on]
    sent = results.join(F.broadcast(hulls), of_kind(results, hulls) & results[moment].between(hulls["_lo"], hulls["_hi"])).select("_piece", results["*"])
    sent = sent.repartition(pieces, "_piece")
    drawn = sent.join(
        F.broadcast(draws), (sent["_piece"] == draws["_piece"]) & of_kind(sent, draws) & sent[moment].between(*[draws[c] for c in span])
    ).select(sent["*"], "contest_id", "ranking", "factor")
    ranked = rank_users(drawn, F.col("ranking"), F.col("factor"), "_piece")
    others = contests.join(sizes.filter(~few).select("contest_id"), "contest_id", "left_semi")
    if others.isEmpty():
        return ranked
    pairs = settle(range_join(results, others, moment, *span, on=[on], how="inner"))
    return ranked.unionByName(rank_users(pairs, F.col("ranking"), F.col("factor")).select(*ranked.columns))


def spread_alike(ranked: DataFrame, alike: DataFrame, prizes: DataFrame) -> DataFrame:
    """Standings of the contests that stand for others, given to all of these, with the prizes of each.

    Users without points get no prize. The contests carry their prizes along, so the standings, once there are all of them, are not exchanged for these.
    """
    offered = prizes.filter("place IS NOT NULL").groupBy("contest_id", F.col("place").cast("bigint").alias("place")).agg(
        F.max("prize_amount").alias("prize_amount")
    )
    listed = offered.groupBy(F.col("contest_id").alias("_of")).agg(F.map_from_entries(F.collect_list(F.struct("place", "prize_amount"))).alias("_prizes"))
    named = settle(alike.join(listed, F.col("contest_id") == F.col("_of"), "left").select("contest_id", "like", "_prizes"))
    side = F.broadcast(named) if named.count() <= FEW_CONTESTS else named
    rows = ranked.withColumnRenamed("contest_id", "_first").join(side, F.col("_first").eqNullSafe(F.col("like")))
    extra = [c for c in ranked.columns if c == "taxable_points"]
    prize = F.try_element_at("_prizes", F.col("current_place").cast("bigint"))
    return rows.select(
        "contest_id", "user_id", "initial_points", "final_points", "potential_points", *extra, "current_place",
        F.when(F.col("final_points") > 0, prize).alias("current_prize"),
    )


def with_prizes(ranked: DataFrame, prizes: DataFrame) -> DataFrame:
    """The prize of a contest's place for every user on it; users without points get none."""
    offered = prizes.groupBy("contest_id", F.col("place").alias("current_place")).agg(
        F.max("prize_amount").alias("current_prize")
    )
    extra = [c for c in ranked.columns if c == "taxable_points"]
    return ranked.join(offered, ["contest_id", "current_place"], "left").select(
        "contest_id", "user_id", "initial_points", "final_points", "potential_points", *extra, "current_place",
        F.when(F.col("final_points") > 0, F.col("current_prize")).alias("current_prize"),
    )


def rank_contests(
    results: DataFrame,
    prizes: DataFrame,
    calculator: Column | str = "points",
    factor: Column | float = 1.0,
) -> DataFrame:
    """Place, points and prize per contest and user.

    ``calculator`` is a registered name, or a column that names one for each row's contest.
    Users rank by final points (equal points share a place); the prize of a
    contest's place goes to every user on it, users without points get none.
    """
    return with_prizes(rank_users(results, calculator, factor), prizes)


def alike_contests(contests: DataFrame, by: Sequence[str]) -> DataFrame:
    """(contest_id, like): a contest of the same ``by`` rows, the same one for all contests alike.

    Contests that draw on the same results by the same rule have the same standings.
    """
    drawn = contests.groupBy("contest_id").agg(F.sort_array(F.collect_list(F.struct(*by))).alias("_drawn"))
    first = drawn.groupBy("_drawn").agg(F.min("contest_id").alias("like"))
    return drawn.join(first, "_drawn").select("contest_id", "like")


def taxable_prizes(ranked: DataFrame, prize: str, taxable: str, points: str, name: str) -> DataFrame:
    """Part of a prize earned with taxable points."""
    return ranked.withColumn(name, taxable_share(prize, taxable, points))


def calculators() -> tuple[Sequence[str], Sequence[str]]:
    """Names of the registered points calculators and contest rankings."""
    return sorted(_points), sorted(_rankings)
