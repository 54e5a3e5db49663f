"""Loads computed from warehouse tables: ranks, streaks, points, contest results, statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.functions import fixed, scalar
from loadstone.operators import aggregates, changes, joins, merge, scoring, sequences
from loadstone.plans.core import LoadContext, Write, change_set, eligible, load, loadable, replacing
from loadstone.session import settle

PROFESSIONAL = 2


def current_ratings(ctx: LoadContext) -> DataFrame:
    """Ratings of active accounts in the rated phases, with school, country and an activity flag.

    Only students have a school.
    """
    phases = [c + fixed.PHASE_OFFSET for c in fixed.RATED_CATEGORIES]
    ratings = ctx.target("user_rating").filter(F.col("phase_id").isin(*phases))
    coders = ctx.target("coder").filter(F.col("status") == "A").select(
        F.col("coder_id").alias("user_id"), "coder_type_id", F.col("comp_country_code").alias("country_code")
    )
    schools = ctx.source("current_school").select(F.col("coder_id").alias("user_id"), "school_id")
    active = sequences.active_users(ratings, ctx.target("project"), ctx.as_of).withColumn("active", F.lit(1))
    rows = ratings.select("user_id", "phase_id", scalar.or_zero("rating").alias("rating")).join(coders, "user_id")
    rows = joins.left_where(joins.left_where(rows, schools, ["user_id"]), active, ["user_id", "phase_id"])
    return rows.withColumns({
        "active": scalar.or_zero("active"),
        "school_id": F.when(F.col("coder_type_id") != PROFESSIONAL, F.col("school_id")),
    })


@load("user_rank", 6)
def user_rank(ctx: LoadContext) -> dict[str, Write]:
    """Ranks per phase, per school and per country, each over all and over active users."""
    ratings = settle(current_ratings(ctx))
    wanted = [(c + fixed.PHASE_OFFSET, t) for c in fixed.RATED_CATEGORIES for t in (fixed.RANK_OVERALL, fixed.RANK_ACTIVE)]
    touched = ratings.sparkSession.createDataFrame(wanted, "phase_id bigint, user_rank_type_id bigint")
    ranked = sequences.rating_ranks_by(ratings, {
        "user_rank": (["phase_id"], None),
        "school_user_rank": (["phase_id", "school_id"], F.col("school_id") > 0),
        "country_user_rank": (["phase_id", "country_code"], None),
    })
    return {
        name: Write(merge.replace_by_key(ctx.target(name), rows, ["phase_id", "user_rank_type_id"], touched))
        for name, rows in ranked.items()
    }


@load("streak", 6)
def streak(ctx: LoadContext) -> dict[str, Write]:
    """Runs of won, paid, rising and falling results; the table is computed anew."""
    projects = ctx.target("project").filter(F.col("status_id").isin(4, 5, 7) & F.col("phase_id").isin(*fixed.STREAK_PHASES)).select(
        "project_id", "phase_id"
    )
    results = ctx.target("project_result").filter((F.col("valid_submission_ind") == 1) & (F.col("rating_ind") == 1)).select(
        "user_id", "project_id", "placed", F.round("new_rating").cast("bigint").alias("rating"), "rating_order"
    )
    rows = sequences.streaks(results.join(projects, "project_id")).withColumnRenamed("user_id", "coder_id")
    return {"streak": Write(rows.select(*ctx.target("streak").columns))}


def touched_tracks(ctx: LoadContext) -> DataFrame:
    return changes.changed_keys([(ctx.source("dr_points"), "track_id", ["modify_date", "create_date"])], ctx.mark(), "track_id")


@load("dr_points", 6)
def dr_points(ctx: LoadContext) -> dict[str, Write]:
    """All points of tracks with a change, percentages resolved against the points they refer to."""
    target, source = ctx.target("dr_points"), ctx.source("dr_points")
    touched = settle(touched_tracks(ctx))
    rows = source.join(touched, "track_id", "left_semi")
    for name in ("status", "type", "operation", "reference_type"):
        key = f"dr_points_{name}_id"
        rows = joins.lookup(rows, ctx.source(f"dr_points_{name}_lu"), {key: key}, {f"dr_points_{name}_desc": f"dr_points_{name}_desc"})
    rows = joins.with_parent_amount(rows, source).withColumn("reference_id", scalar.or_zero("reference_id"))
    return {"dr_points": replacing(ctx, "dr_points", change_set(target, rows), ["track_id"], touched)}


def named_calculator(ctx: LoadContext, column: str) -> Column:
    """Registered ranking of a class name; ``calculators`` in the options maps names. Others fail when they are used."""
    value = F.col(column)
    for old, new in ctx.options.get("calculators", {}).items():
        value = F.when(F.col(column) == old, new).otherwise(value)
    return value


@load("track_contest_results", 7)
def track_contest_results(ctx: LoadContext) -> dict[str, Write]:
    """Places and prizes in the contests of changed tracks.

    ``track_prizes`` in the options names a source table (contest_id, place,
    prize_amount); without it nobody gets a prize.
    """
    target = ctx.target("track_contest_results")
    contests = ctx.source("track_contest").join(touched_tracks(ctx), "track_id", "left_semi").join(
        ctx.source("track_contest_type_lu").select("track_contest_type_id"), "track_contest_type_id", "left_semi"
    ).join(
        ctx.source("track_contest_result_calculator_lu").select("track_contest_result_calculator_id", "class_name"),
        "track_contest_result_calculator_id",
    ).select("track_id", F.col("track_contest_id").alias("contest_id"), named_calculator(ctx, "class_name").alias("ranking"))
    contests = settle(contests)
    of_result = F.col("dr_points_reference_type_id") == 1
    points = ctx.target("dr_points").join(contests.select("track_id"), "track_id", "left_semi").select(
        "track_id", "user_id", "amount", "is_potential", F.when(of_result, F.col("reference_id")).alias("project_id")
    )
    results = ctx.target("project_result").select(
        "project_id", "user_id", F.col("placed"), (scalar.or_zero("payment") == 0).alias("_taxable")
    )
    rows = points.join(results, ["project_id", "user_id"], "left")
    potential = F.coalesce(F.col("is_potential"), F.lit(False))
    amount, none = F.col("amount"), F.lit(0)
    # One row per track, user and place first: contests of a track share them.
    per_user = rows.groupBy("track_id", "user_id", scalar.or_zero("placed").alias("placed")).agg(
        F.sum(F.when(potential, none).otherwise(amount)).alias("points_awarded"),
        F.sum(F.when(potential, amount).otherwise(none)).alias("potential_points"),
        F.sum(F.when(~potential & F.coalesce("_taxable", F.lit(False)), amount).otherwise(none)).alias("taxable_points"),
    ).withColumn("final_points", F.col("points_awarded"))
    # Contests of a track with the same rule have the same standings: one of them is ranked, its rows are spread to all.
    alike = settle(scoring.alike_contests(contests, ["track_id", "ranking"]))
    first = alike.select(F.col("like").alias("_first")).distinct()
    in_first = settle(per_user.join(contests.join(first, F.col("contest_id").eqNullSafe(F.col("_first")), "left_semi"), "track_id"))
    standings = scoring.rank_users(in_first, F.col("ranking"), 2.0)
    # In pieces of their own: what the spread makes of a row grows with the contests.
    pieces = int(standings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    standings = standings.repartition(pieces)
    table = ctx.options.get("track_prizes")
    prizes = ctx.source(table) if table else ctx.target("track_contest_results").select(
        F.col("track_contest_id").alias("contest_id"), F.lit(1).alias("place"), F.col("track_contest_prize").alias("prize_amount")
    ).filter(F.lit(False))
    rows = scoring.spread_alike(standings, alike, prizes).select(
        F.col("contest_id").alias("track_contest_id"), "user_id", F.col("current_place").alias("track_contest_placement"),
        F.col("current_prize").alias("track_contest_prize"),
        scalar.taxable_share(
            F.col("current_prize").cast("double"), F.col("taxable_points").cast("double"), F.col("final_points").cast("double")
        ).alias("taxable_track_contest_prize"),
    )
    gone = contests.select(F.col("contest_id").alias("track_contest_id"))
    return {"track_contest_results": Write(merge.replace_by_key(target, rows, ["track_contest_id"], gone, few=scoring.FEW_CONTESTS))}


def posting_dates(ctx: LoadContext) -> DataFrame:
    """(project_id, actual start of registration, else of submission)."""
    started = lambda kind: F.max(F.when(F.col("phase_type_id") == kind, F.col("actual_start_time")))
    return ctx.source("project_phase").filter(F.col("phase_type_id").isin(1, 2)).groupBy("project_id").agg(
        F.coalesce(started(1), started(2)).alias("posted")
    ).filter("posted IS NOT NULL")


def checked_prizes(ctx: LoadContext) -> DataFrame:
    """Prizes per contest and place; a missing place before a prize is an error."""
    listed = sequences.place_gaps(ctx.source("contest_prize").select("contest_id", "place", "prize_amount"), ["contest_id"], "place")
    problem = F.raise_error(F.concat(F.lit("a prize is missing in contest "), F.col("contest_id").cast("string")))
    return listed.filter(F.when(F.col("gap") == 1, problem.cast("boolean")).otherwise(True)).select("contest_id", "place", "prize_amount")


@load("contest_result", 6)
def contest_result(ctx: LoadContext) -> dict[str, Write]:
    """Standings of the contests of every stage in which a project or result changed."""
    target = ctx.target("contest_result")
    posted = settle(posting_dates(ctx))
    stages = ctx.source("stage").select("stage_id", "start_date", "end_date")
    results = ctx.source("project_result")
    changed = loadable(ctx).select("project_id", F.col("modify_date").alias("m_p")).join(
        results.groupBy("project_id").agg(F.max("modify_date").alias("m_pr")), "project_id"
    ).filter(ctx.changed("m_p", "m_pr"))
    touched = joins.spans_with_points(
        stages, posted.join(changed, "project_id", "left_semi"), "posted", "start_date", "end_date"
    ).select("stage_id").distinct()
    contests = ctx.source("contest_stage_xref").join(touched, "stage_id", "left_semi").join(
        ctx.source("contest").select("contest_id", "project_category_id", "contest_result_calculator_id"), "contest_id"
    ).join(ctx.source("contest_result_calculator_lu"), "contest_result_calculator_id").join(stages, "stage_id").select(
        "contest_id", "start_date", "end_date", F.col("top_performers_factor").cast("double").alias("factor"),
        named_calculator(ctx, "class_name").alias("ranking"),
        # A development contest takes the results of component testing too.
        F.explode(F.when(F.col("project_category_id") == 2, F.array(F.lit(2), F.lit(5))).otherwise(F.array(F.col("project_category_id").cast("int")))).alias("project_category_id"),
    )
    contests = settle(contests)

    # Projects of the time of the touched contests first; everything below is cut down to them.
    times = settle(contests.groupBy("project_category_id").agg(F.min("start_date").alias("_lo"), F.max("end_date").alias("_hi")))
    projects = eligible(ctx, ctx.source("project")).select("project_id", F.col("project_category_id").cast("int").alias("project_category_id"), "project_status_id")
    projects = projects.join(times, "project_category_id").join(posted, "project_id").filter("posted BETWEEN _lo AND _hi").drop("_lo", "_hi")
    projects = settle(projects)
    only = projects.select("project_id").distinct()
    attributes = joins.pivot_attributes(
        ctx.source("project_info").join(only, "project_id", "left_semi"), "project_id", {n: fixed.PROJECT_ATTRIBUTES[n] for n in ("run_points", "amount", "run_flag")}, "project_info_type_id"
    ).filter(F.col("run_flag") == "On").select(
        "project_id", F.coalesce(scalar.to_money("run_points"), scalar.to_money("amount")).alias("amount")
    )
    # Settled step by step, and large tables pass a sieve of the ids wanted of them, so that little is exchanged at once.
    paying = settle(projects.join(attributes, "project_id"))
    wanted = joins.Sieve.of(paying.select("project_id"))
    near = lambda df: wanted.rows(df, "project_id").join(paying.select("project_id"), "project_id", "left_semi")

    uploads = settle(near(ctx.source("upload").select("upload_id", "project_id", "resource_id")))
    status = F.col("submission_status_id")
    contest = ctx.source("submission").filter(F.col("submission_type_id") == 1).select("upload_id", "submission_status_id")
    sent = settle(joins.Sieve.of(uploads.select("upload_id")).rows(contest, "upload_id").join(uploads, "upload_id"))
    rows = aggregates.with_child_values(
        paying, sent, "project_id", {"num_submissions_passed_review": aggregates.count_where(status.isin(1, 4))},
        zero=["num_submissions_passed_review"],
    )
    named = ctx.source("resource_info").filter(F.col("resource_info_type_id") == 1).select("resource_id", scalar.to_long("value").alias("user_id"))
    handed = sent.filter(status.isin(1, 2, 3, 4)).select("project_id", "resource_id")
    named = joins.Sieve.of(sent.select("resource_id")).rows(named, "resource_id")
    submitters = settle(handed.join(named, "resource_id").select("project_id", "user_id"))
    scores = near(results).select("project_id", "user_id", "placed", "point_adjustment", "final_score", "valid_submission_ind", "rating_ind")
    scores = joins.exists_flag(scores, submitters, ["project_id", "user_id"], "submitted")
    scores = scores.withColumn("valid_submission_ind", F.when(F.col("submitted") == 1, F.col("valid_submission_ind")).otherwise(0))
    rows = rows.join(scores, "project_id").filter(
        ((F.col("rating_ind") == 1) | (F.col("project_category_id") == 5))
        & ((F.col("valid_submission_ind") == 1) | (F.col("project_status_id") == fixed.STATUS_COMPLETED))
    ).withColumn("calculator", F.lit("placement"))
    # What a result is worth does not depend on the contest: contests meet the results last.
    scored = settle(scoring.score_results(rows).select(
        "project_category_id", "posted", "user_id", "placed", "points_awarded", "final_points", "potential_points"
    ))
    alike = settle(scoring.alike_contests(contests, ["project_category_id", "start_date", "end_date", "ranking", "factor"]))
    first = contests.join(alike.select(F.col("like").alias("contest_id")).distinct(), "contest_id", "left_semi")
    ranked = scoring.standings(scored, settle(first), "posted", "project_category_id")
    ranked = scoring.spread_alike(ranked, alike, checked_prizes(ctx)).withColumnRenamed("user_id", "coder_id")
    gone = settle(contests.select("contest_id").distinct())
    rows = merge.replace_by_key(ctx.around("contest_result", gone), ranked, ["contest_id"], gone, few=scoring.FEW_CONTESTS)
    return {"contest_result": Write(rows, touched=gone)}


@load("tcd_project_stat", 6)
def direct_project_stats(ctx: LoadContext) -> dict[str, Write]:
    """Daily statistics per direct project and category; the table is computed anew."""
    rows = aggregates.daily_stats(ctx.target("project")).withColumns({
        "create_user": F.lit("loadstone"), "create_date": ctx.now(), "modify_user": F.lit("loadstone"), "modify_date": ctx.now(),
    })
    target = ctx.target("tcd_project_stat")
    return {"tcd_project_stat": Write(rows.select(*[F.col(f.name).cast(f.dataType) for f in target.schema]))}


@load("deleted_projects", 8)
def deleted_projects(ctx: LoadContext) -> dict[str, Write]:
    """Rows of deleted projects leave every table; tables without such rows are not rewritten."""
    gone = settle(ctx.source("project").filter(F.col("project_status_id") == fixed.STATUS_DELETED).select("project_id"))
    tables = {name: ctx.target(name) for name, _ in fixed.PROJECT_TABLES}
    left = merge.cascade_delete(tables, fixed.PROJECT_TABLES, gone)
    # One job asks all tables, each for the keys it refers to by; at most one row per table comes back.
    hits = [
        tables[name].select(column).join(gone.withColumnRenamed("project_id", column), column, "left_semi").select(F.lit(name).alias("name"))
        for name, column in fixed.PROJECT_TABLES
    ]
    found = {r.name for r in reduce(DataFrame.unionByName, hits).distinct().collect()}
    return {name: Write(left[name]) for name in tables if name in found}
