"""Loads of results, payments, participations and ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.functions import fixed, scalar
from loadstone.operators import aggregates, changes, joins, merge, scoring, sequences
from loadstone.plans.core import LoadContext, Write, change_set, eligible, load, loadable, replacing, upsert_load
from loadstone.session import settle

# The category whose results come from its submissions.
SUBMISSION_SCORED = 38
# Scorecard types of reviews, states of live submissions.
REVIEW_SCORECARDS = (2, 8)
LIVE = (1, 2, 3, 4)
STUDIO_TYPE = 3
STUDIO_SKIPPED = (1, 2, 3, 9, 10, 11)


def reference(ctx: LoadContext, attribute: int, name: str) -> DataFrame:
    """(project_id, id held as text in an attribute) with the attribute's stamps."""
    return ctx.source("project_info").filter(F.col("project_info_type_id") == attribute).select(
        "project_id", scalar.to_long("value").alias(name), F.col("modify_date").alias("m_pi"), F.col("modify_user").alias("w_pi")
    )


def changed_with_component(ctx: LoadContext, projects: DataFrame, results: DataFrame | None, first: bool = False) -> DataFrame:
    """Ids of the projects that have a version and a component, with a change in any of them."""
    rows = projects.select("project_id", F.col("modify_date").alias("m_p"), F.col("modify_user").alias("w_p"))
    rows = rows.join(reference(ctx, 1, "comp_vers_id"), "project_id").join(
        ctx.source("comp_versions").select("comp_vers_id", "component_id", F.col("modify_date").alias("m_cv")), "comp_vers_id"
    ).join(ctx.source("comp_catalog").select("component_id", F.col("modify_date").alias("m_cc")), "component_id")
    stamps = ["m_p", "m_cv", "m_pi", "m_cc"]
    if results is not None:
        latest = results.groupBy("project_id").agg(F.max("modify_date").alias("m_pr"))
        rows = rows.join(latest, "project_id")
        stamps.append("m_pr")
    if not first:
        rows = rows.filter(ctx.changed(*stamps, users=["w_p", "w_pi"]))
    return rows.select("project_id").distinct()


def entries(ctx: LoadContext, only: DataFrame) -> DataFrame:
    """What the submissions of a submitter in a project add up to, in one pass."""
    uploads = ctx.source("upload").select("upload_id", "project_id", "resource_id", F.col("create_date").alias("uploaded")).join(
        only, "project_id", "left_semi"
    )
    sent = ctx.source("submission").filter(F.col("submission_type_id") == 1).select(
        "submission_id", "upload_id", "submission_status_id", "placement", "initial_score", "final_score", "prize_id"
    )
    prizes = ctx.source("prize").select("prize_id", "prize_amount")
    graded = ctx.source("scorecard").filter(F.col("scorecard_type_id").isin(*REVIEW_SCORECARDS)).select("scorecard_id")
    committed = ctx.source("review").filter(F.col("committed") == 1).select("submission_id", "scorecard_id", "modify_date")
    # Many reviews share a scorecard: those in use are few, and the reviews need no exchange to meet them.
    graded = settle(graded.join(committed.select("scorecard_id").distinct(), "scorecard_id", "left_semi"))
    reviewed = committed.join(graded, "scorecard_id", "left_semi").groupBy("submission_id").agg(F.max("modify_date").alias("reviewed"))
    rows = uploads.join(sent, "upload_id").join(prizes, "prize_id", "left").join(reviewed, "submission_id", "left")
    live = F.col("submission_status_id").isin(*LIVE)
    top = live & (F.col("placement") == 1)
    won = top & (F.col("final_score") == 100)
    kept = F.col("submission_status_id") != 5
    best = lambda condition, column: F.max(F.when(condition, F.col(column)))
    return rows.groupBy("project_id", "resource_id").agg(
        F.max(F.when(live, 1).otherwise(0)).alias("submitted"),
        F.max(F.when(won, 1).otherwise(0)).alias("won"),
        best(top, "initial_score").alias("top_initial"),
        best(top, "final_score").alias("top_final"),
        best(won, "prize_amount").alias("top_prize"),
        best(kept, "uploaded").alias("submit_timestamp"),
        best(kept, "reviewed").alias("review_complete_timestamp"),
    )


def result_rows(ctx: LoadContext, only: DataFrame) -> DataFrame:
    """Results of the given projects, one row per project and user."""
    results = ctx.source("project_result").join(only, "project_id", "left_semi")
    project = ctx.source("project").join(only, "project_id", "left_semi").select("project_id", "project_category_id")
    components = reference(ctx, 2, "component_id").join(ctx.source("comp_catalog").select("component_id"), "component_id", "left_semi")
    versions = reference(ctx, 1, "comp_vers_id").join(ctx.source("comp_versions").select("comp_vers_id"), "comp_vers_id", "left_semi")
    info = ctx.source("resource_info")
    named = info.filter(F.col("resource_info_type_id") == 1).select("resource_id", scalar.to_long("value").alias("user_id"))
    submitters = settle(
        ctx.source("resource").filter(F.col("resource_role_id") == 1).select("resource_id", "project_id")
        .join(only, "project_id", "left_semi").join(named, "resource_id")
    )
    # Parsed in a step of its own: reading a text in five forms is more code than fits beside an aggregate.
    texts = settle(
        info.filter(F.col("resource_info_type_id") == 6).join(submitters, "resource_id", "left_semi")
        .groupBy("resource_id").agg(F.max("value").alias("registered_text"))
    )
    registered = settle(texts.select("resource_id", scalar.parse_timestamp("registered_text").alias("registered")))
    inquiries = ctx.source("component_inquiry").groupBy("project_id", "user_id").agg(F.max("create_time").alias("inquired"))
    reliability = ctx.source("project_reliability").select(
        "project_id", "user_id", F.col("reliability_before_resolution").alias("old_reliability"),
        F.col("reliability_after_resolution").alias("new_reliability"), "reliable_ind",
    )
    # What hangs on a resource is joined to the submitters, so the wide rows of results are exchanged by project and user only.
    entered = submitters.join(entries(ctx, only), ["project_id", "resource_id"], "left").join(registered, "resource_id", "left")
    rows = (
        results.join(project, "project_id")
        .join(components.select("project_id"), "project_id", "left_semi")
        .join(versions.select("project_id"), "project_id", "left_semi")
        .join(entered, ["project_id", "user_id"])
        .join(inquiries, ["project_id", "user_id"], "left")
        .join(reliability, ["project_id", "user_id"], "left")
    )
    scored = F.col("project_category_id") == SUBMISSION_SCORED
    won = scalar.or_zero("won")
    passed = F.when(scored, won).otherwise(F.col("passed_review_ind"))
    columns = {
        "submit_ind": scalar.or_zero("submitted"),
        "valid_submission_ind": F.when(scored, won).when(F.col("submitted") == 1, F.col("valid_submission_ind")).otherwise(0),
        "raw_score": F.when(scored, F.col("top_initial")).otherwise(F.col("raw_score")),
        "final_score": F.when(scored, F.col("top_final")).otherwise(F.col("final_score")),
        "inquire_timestamp": F.coalesce("inquired", "registered"),
        "payment": F.when(scored, F.col("top_prize")).otherwise(F.col("payment")),
        "passed_review_ind": passed,
        "placed": F.when(F.col("placed").isNull() & scored & (won == 1), 1).otherwise(F.col("placed")),
        "reliable_submission_ind": scalar.or_zero("reliable_ind"),
        "old_rating_id": scalar.rating_key("old_rating"),
        "new_rating_id": scalar.rating_key("new_rating"),
    }
    same = ("project_id", "user_id", "submit_timestamp", "review_complete_timestamp", "old_rating", "new_rating", "old_reliability",
            "new_reliability", "rating_ind", "rating_order")
    return merge.last_per_key(rows.select(*same, *[c.alias(n) for n, c in columns.items()]), ["project_id", "user_id"])


@load("project_result", 5)
def project_result(ctx: LoadContext) -> dict[str, Write]:
    """Results of changed projects replace the old ones; then rating counts and appeals are added.

    Ratings are counted over the finished table, and written back to every row of the
    users concerned: a late result also moves the counts of the rows after it. So
    steps give what one load of everything gives.
    """
    target = ctx.target("project_result")
    touched = settle(changed_with_component(ctx, loadable(ctx), ctx.source("project_result")))
    rows = change_set(target, result_rows(ctx, touched))
    keys = ["project_id", "user_id"]
    appeals = ctx.target("submission_review").join(touched, "project_id", "left_semi").groupBy(*keys).agg(
        F.sum("num_appeals").alias("num_appeals"), F.sum("num_successful_appeals").alias("num_successful_appeals")
    )
    rows = merge.annotate(rows, appeals, keys, ["num_appeals", "num_successful_appeals"])
    state = merge.replace_by_key(target, rows, ["project_id"], touched)

    users = target.join(touched, "project_id", "left_semi").select("user_id").unionByName(rows.select("user_id")).distinct()
    dated = state.select(*keys, "rating_ind").join(users, "user_id", "left_semi").join(
        ctx.target("project").select("project_id", "phase_id", "rating_date"), "project_id", "left"
    )
    counted = sequences.prior_count(
        dated, ["user_id", "phase_id"], ["rating_date", "project_id"], F.col("rating_ind") == 1, "num_ratings"
    )
    moved = touched.unionByName(state.join(users, "user_id", "left_semi").select("project_id"))
    counts = counted.select(*keys, "num_ratings")
    return {"project_result": Write(merge.upsert_columns(state, counts, keys, ["num_ratings"]), touched=moved)}


@load("result_points", 6)
def result_points(ctx: LoadContext) -> dict[str, Write]:
    """Points of results on the active tracks their category and posting date fall in.

    Completed projects earn awarded points, active ones with a valid
    submission potential ones. Rows get ids above the ones in use.
    """
    target = ctx.target("result_points")
    touched = settle(changed_with_component(ctx, loadable(ctx), ctx.source("project_result")))
    info = ctx.source("project_info").join(touched, "project_id", "left_semi")
    wide = joins.pivot_attributes(
        info, "project_id", {n: fixed.PROJECT_ATTRIBUTES[n] for n in ("run_points", "amount", "run_flag")}, "project_info_type_id"
    ).select(
        "project_id", F.coalesce(scalar.to_money("run_points"), scalar.to_money("amount")).alias("amount"), "run_flag"
    ).filter(F.col("run_flag") == "On")
    phases = ctx.source("project_phase").filter(F.col("phase_type_id").isin(1, 2, 6, 21)).join(touched, "project_id", "left_semi")
    started = lambda kind: F.max(F.when(F.col("phase_type_id") == kind, F.col("actual_start_time")))
    announced = F.max(F.when(F.col("phase_type_id").isin(6, 21), F.coalesce("actual_end_time", "scheduled_end_time")))
    dates = phases.groupBy("project_id").agg(
        F.coalesce(started(1), started(2)).alias("posting_date"), announced.alias("winner_announced")
    ).filter("posting_date IS NOT NULL")
    # Only what belongs to projects that pay is exchanged from here on.
    states = ctx.source("project").select("project_id", "project_category_id", "project_status_id").filter(F.col("project_status_id").isin(1, 7, 8))
    paying = settle(joins.Sieve.of(touched).rows(states, "project_id").join(settle(wide), "project_id").join(settle(dates), "project_id"))
    wanted = joins.Sieve.of(paying.select("project_id"))
    near = lambda table: wanted.rows(ctx.source(table), "project_id").join(paying.select("project_id"), "project_id", "left_semi")
    uploads = settle(near("upload").select("upload_id", "project_id"))
    passing = ctx.source("submission").filter((F.col("submission_type_id") == 1) & F.col("submission_status_id").isin(1, 4)).select("upload_id")
    passed = uploads.join(joins.Sieve.of(uploads.select("upload_id")).rows(passing, "upload_id"), "upload_id")
    paying = settle(aggregates.with_child_values(
        paying, passed, "project_id", {"num_submissions_passed_review": F.count(F.lit(1))}, zero=["num_submissions_passed_review"]
    ))
    rows = near("project_result").select(
        "project_id", "user_id", "placed", "point_adjustment", "final_score", "valid_submission_ind"
    ).join(paying, "project_id")
    tracks = ctx.source("track").filter(F.col("track_status_id") == 1).join(
        ctx.source("points_calculator_lu").select("points_calculator_id", F.col("class_name").alias("calculator")), "points_calculator_id"
    ).join(ctx.source("track_project_category_xref"), "track_id").select(
        "track_id", "project_category_id", "calculator", "track_start_date", "track_end_date"
    )
    # Every track repeats the results of its time: they are put in order once, before that, and dealt to pieces. The tracks come to the
    # pieces, and the rows on tracks, far more than there are results, are made and numbered where they are, once to count them and once to keep them.
    pieces = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = settle(rows.repartitionByRange(pieces, "project_id", "user_id").withColumn("_part", F.spark_partition_id()))
    on_track = joins.range_join(
        rows.repartitionById(pieces, "_part"), tracks, "posting_date", "track_start_date", "track_end_date",
        on=["project_category_id"], how="inner", few=scoring.FEW_CONTESTS,
    )
    names = ctx.options.get("calculators", {})
    for old, new in names.items():
        on_track = on_track.withColumn("calculator", F.when(F.col("calculator") == old, new).otherwise(F.col("calculator")))
    scored = scoring.score_results(on_track)
    closed = F.col("project_status_id").isin(7, 8)
    gain = F.when(closed, F.col("final_points")).otherwise(F.col("potential_points") + F.col("point_adjustment"))
    won = scored.withColumn("amount", gain.cast("decimal(10,2)")).filter(
        (F.col("amount") > 0) & (closed | (F.col("valid_submission_ind") == 1))
    )
    rows = won.select(
        "_part", "track_id", "user_id", "amount", F.col("posting_date").alias("application_date"), F.col("project_id").alias("reference_id"),
        F.when(closed, F.col("winner_announced")).alias("award_date"), (~closed).alias("is_potential"),
    )
    kept = merge.delete_keys(target, touched, "reference_id", "project_id")
    last = kept.agg(F.coalesce(F.max("dr_points_id"), F.lit(0))).first()[0]
    numbered = sequences.block_keys(rows, ["track_id", "_part"], ["reference_id", "user_id"], "dr_points_id", last)
    return {"result_points": Write(kept.unionByName(numbered.select(*[F.col(f.name).cast(f.dataType) for f in target.schema])))}


@load("design_project_result", 4)
def design_project_result(ctx: LoadContext) -> dict[str, Write]:
    """Submissions of design contests with their points, and a row per registrant without one."""
    target = ctx.target("design_project_result")
    kinds = ctx.source("project_category_lu").filter(F.col("project_type_id") == STUDIO_TYPE).select("project_category_id")
    projects = eligible(ctx, ctx.source("project").filter(~F.col("project_status_id").isin(*STUDIO_SKIPPED))).join(
        kinds, "project_category_id", "left_semi"
    )
    touched = settle(changed_with_component(ctx, projects, None, changes.is_first_run(target)))
    # Only what belongs to these projects is exchanged: large tables pass a sieve of the ids that are wanted of them before they are joined.
    wanted = joins.Sieve.of(touched)
    near = lambda table: wanted.rows(ctx.source(table), "project_id").join(touched, "project_id", "left_semi")
    registered = near("resource").filter(F.col("resource_role_id") == 1).select(
        "project_id", "resource_id", "user_id", F.col("create_date").alias("inquire_timestamp")
    )
    uploads = settle(near("upload").select(
        "project_id", "resource_id", "upload_id", F.col("create_date").alias("submit_timestamp"),
        ((F.col("upload_status_id") == 1) & (F.col("upload_type_id") == 1)).alias("live"),
    ))
    live = uploads.filter("live").drop("live")
    contest = (F.col("submission_type_id") == 1) & ~F.coalesce(F.col("mark_for_purchase"), F.lit(False))
    shown = (F.col("submission_status_id") != 5) & F.col("submission_type_id").isin(1, 3)
    sent = settle(joins.Sieve.of(uploads.select("upload_id")).rows(ctx.source("submission").filter(contest | shown), "upload_id").select(
        "submission_id", "upload_id", "submission_type_id", "submission_status_id", "placement", "mark_for_purchase", "prize_id"
    ))
    prizes = settle(joins.Sieve.of(sent.select("prize_id")).rows(ctx.source("prize"), "prize_id").select("prize_id", "prize_amount"))
    committed = ctx.source("review").filter(F.col("committed") == 1)
    reviewed = joins.Sieve.of(sent.select("submission_id")).rows(committed, "submission_id").groupBy("submission_id").agg(
        F.max("modify_date").alias("review_complete_timestamp")
    )
    marked = F.coalesce(F.col("mark_for_purchase"), F.lit(False))
    placements = uploads.select("upload_id", "project_id").join(sent.filter(contest), "upload_id").join(prizes, "prize_id", "left_semi")
    attributes = joins.pivot_attributes(
        near("project_info"), "project_id", {n: fixed.PROJECT_ATTRIBUTES[n] for n in ("run_points", "run_flag")}, "project_info_type_id",
    ).select("project_id", F.when(F.col("run_flag") == "On", scalar.to_money("run_points")).cast("double").alias("total_points"))

    # One row per project, settled: its measured size decides whether the wide rows have to move for it.
    contests = settle(aggregates.with_child_values(
        touched.join(attributes, "project_id", "left"), placements, "project_id", {"placements": F.count(F.lit(1))}, zero=["placements"]
    ))

    entered = registered.join(live, ["project_id", "resource_id"], "left")
    sent_rows = entered.join(sent.filter(shown), "upload_id")
    rows = sent_rows.join(prizes.withColumn("has_prize", F.lit(1)), "prize_id", "left").join(reviewed, "submission_id", "left")
    rows = rows.join(contests, "project_id")
    checkpoint = F.col("submission_type_id") == 3
    counts = ~checkpoint & ~marked
    place = scalar.or_zero("placement")
    points = scalar.placement_points(F.coalesce("total_points", F.lit(0.0)), F.col("placements"), place)
    has_prize = F.col("has_prize") == 1
    submitted = rows.select(
        "project_id", "user_id", "submission_id", "upload_id", F.when(has_prize, F.col("prize_id")).alias("prize_id"), "prize_amount",
        F.when(counts, place).alias("placement"), F.when(counts & has_prize, points).alias("dr_points"),
        F.when(checkpoint, 1).otherwise(0).alias("is_checkpoint"), F.when(marked, 1).otherwise(0).alias("client_selection"),
        "submit_timestamp", "review_complete_timestamp", "inquire_timestamp", F.lit(1).alias("submit_ind"),
        F.when(F.col("submission_status_id").isin(1, 4), 1).otherwise(0).alias("valid_submission_ind"),
    )
    absent = entered.filter("upload_id IS NULL").groupBy("project_id", "user_id").agg(F.min("inquire_timestamp").alias("inquire_timestamp"))
    absent = absent.withColumns({"submission_id": F.lit(0), "submit_ind": F.lit(0), "valid_submission_ind": F.lit(0)})
    rows = change_set(target, submitted.unionByName(absent, allowMissingColumns=True))
    return {"design_project_result": Write(merge.replace_by_key(target, rows, ["project_id"], touched))}


@load("payment", 4)
def payment(ctx: LoadContext) -> dict[str, Write]:
    """Payments with a changed detail or a changed type, written to two tables."""
    details, types = ctx.source("payment_detail"), ctx.source("payment_type_lu")
    kinds = types.select(
        "payment_type_id", "payment_type_desc", "payment_reference_id", "show_in_profile_ind", "show_details_ind",
        F.col("modify_date").alias("m_type"), F.col("create_date").alias("c_type"),
    )
    changed = ctx.changed("date_modified", "create_date", "m_type", "c_type")
    touched = details.select("payment_detail_id", "payment_type_id", "date_modified", "create_date").join(kinds, "payment_type_id").filter(
        changed
    ).join(ctx.source("payment_detail_xref"), "payment_detail_id").select("payment_id").distinct()
    states = ctx.source("payment_status_lu").select("payment_status_id", "payment_status_desc")
    heads = ctx.source("payment").select("payment_id", F.col("most_recent_detail_id").alias("payment_detail_id"))
    rows = (
        details.filter(F.col("payment_status_id") != fixed.PAYMENT_DELETED).join(kinds, "payment_type_id").filter(changed)
        .join(heads, "payment_detail_id").join(states, "payment_status_id")
        .withColumns({
            "reference_id": scalar.pick_by_code("payment_reference_id", fixed.PAYMENT_REFERENCES),
            "parent_payment_id": scalar.or_zero("parent_payment_id"),
            "jira_ticket_id": F.col("jira_issue_id"),
        })
    )
    calendar, times = ctx.target("calendar"), ctx.target("time")
    rows = joins.calendar_lookup(
        rows, calendar,
        {"modified_calendar_id": "date_modified", "created_calendar_id": "create_date", "due_calendar_id": "date_due", "paid_calendar_id": "date_paid"},
        strict=True,
    )
    rows = joins.time_lookup(rows, times, {"modified_time_id": "date_modified", "created_time_id": "create_date"}, strict=True)
    targets = {name: ctx.target(name) for name in ("payment", "user_payment")}
    columns = dict.fromkeys(c for t in targets.values() for c in t.columns)
    rows, touched = settle(rows.select(*columns)), settle(touched)
    every = settle(touched.unionByName(rows.select("payment_id")).distinct())
    writes = {name: replacing(ctx, name, rows, ["payment_id"], every) for name in targets}
    if merge.is_unfilled(targets["payment"], "jira_ticket_id"):
        # The tickets of all payments are filled in once, which touches every row.
        known = details.join(heads, "payment_detail_id").select("payment_id", F.col("jira_issue_id").alias("jira_ticket_id"))
        filled = merge.upsert_columns(targets["payment"], known.filter("jira_ticket_id IS NOT NULL"), ["payment_id"], ["jira_ticket_id"])
        writes["payment"] = Write(merge.replace_by_key(filled, rows, ["payment_id"], every))
    return writes


@load("participation", 4)
def participation(ctx: LoadContext) -> dict[str, Write]:
    """Days on which users took part in a round, a match or a project; rows are only added."""
    mark = ctx.mark()
    day = lambda column: F.date_trunc("day", column).cast("timestamp_ntz").alias("participation_date")
    starts = ctx.source("round_segment").filter((F.col("segment_id") == 1) & changes.is_changed(mark, "start_time")).select(
        "round_id", "start_time"
    )

    def rounds(table: str, types: tuple[int, ...], kind: int, *more) -> DataFrame:
        attended = ctx.source(table).filter(F.col("attended") == "Y")
        for condition in more:
            attended = attended.filter(condition)
        chosen = ctx.source("round").filter(F.col("round_type_id").isin(*types)).select("round_id").join(starts, "round_id")
        return attended.join(chosen, "round_id").select(
            F.col("coder_id").alias("user_id"), F.lit(kind).alias("participation_type"), day("start_time")
        )

    kinds = ctx.source("project_category_lu").filter(F.col("project_type_id").isin(1, 2, 3)).select("project_category_id", "project_type_id")
    named = ctx.source("resource_info").filter(F.col("resource_info_type_id") == 1).select("resource_id", scalar.to_long("value").alias("user_id"))
    resources = ctx.source("resource").filter(
        F.col("resource_role_id").isin(1, 2, 4, 5, 6, 7, 8, 9) & changes.is_changed(mark, "create_date")
    ).select("resource_id", "project_id", "create_date")
    open_to_all = joins.excluding(resources, ctx.source("contest_eligibility"), {"project_id": "contest_id"})
    in_projects = (
        open_to_all.join(named, "resource_id").join(ctx.source("project").select("project_id", "project_category_id"), "project_id")
        .join(kinds, "project_category_id")
        .select("user_id", F.when(F.col("project_type_id").isin(1, 2), 3).otherwise(4).alias("participation_type"), day("create_date"))
    )
    rows = (
        rounds("room_result", (1, 2, 10), 1, F.col("room_seed").isNotNull())
        .unionByName(rounds("long_comp_result", (13, 15, 19, 22, 25), 2))
        .unionByName(in_projects)
    ).distinct()
    target = ctx.target("participation")
    return {"participation": Write(merge.append_new(target, rows, target.columns), "append")}


@upsert_load("user_rating", 5, ["user_id", "phase_id"], update=[
    "rating", "vol", "rating_no_vol", "num_ratings", "last_rated_project_id", "mod_date_time", "highest_rating", "lowest_rating",
])
def user_rating(ctx):
    """Current ratings with the highest and lowest ever."""
    rows = ctx.source("user_rating").filter(changes.is_changed(ctx.mark(), "mod_date_time"))
    projects = eligible(ctx, ctx.source("project")).select(
        "project_id", (F.col("project_category_id") + fixed.PHASE_OFFSET).alias("phase_id")
    )
    rated = ctx.source("project_result").filter(F.col("rating_ind") == 1).join(projects, "project_id")
    extremes = sequences.high_low(rated, ["user_id", "phase_id"], "new_rating", "highest_rating", "lowest_rating")
    return rows.join(extremes, ["user_id", "phase_id"], "left").withColumns({
        "highest_rating": scalar.or_zero("highest_rating"), "lowest_rating": scalar.or_zero("lowest_rating"),
        "mod_date_time": ctx.now(), "create_date_time": ctx.now(),
    })
