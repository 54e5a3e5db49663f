"""Loads of the project table and what hangs on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.functions import fixed, scalar
from loadstone.operators import aggregates, changes, joins, merge
from loadstone.plans.core import LoadContext, Write, eligible, load
from loadstone.session import settle, settle_alone

# Phase types.
REGISTRATION, SUBMISSION, REVIEW, FINAL_FIX, APPROVAL, CHECKPOINT, CHECKPOINT_END = 1, 2, 4, 10, 11, 15, 17
# Resource roles.
SUBMITTER, MANAGER, COPILOT = 1, 13, 14
# Accounts that stand for no manager.
NO_MANAGER = (22770213, 22719217)
# Prize types and submission types.
PRIZE, CHECKPOINT_PRIZE = 15, 14
CONTEST_SUBMISSION, CHECKPOINT_SUBMISSION = 1, 3
# Attributes whose change makes a project load again.
WATCHED_ATTRIBUTES = (2, 3, 21, 22, 23, 26, 31, 32, 33, 38, 45, 49)
MATCH_ATTRIBUTES = (2, 3, 21, 22, 23, 26, 31, 32, 56, 57)
# Categories with a review phase as their last one, the match category.
REVIEWED_CATEGORIES = (9, 29, 39)
MATCH_CATEGORY = 37
MAX_VERSION = 999
STUDIO_TYPE = 3

COST_CLASSES = {
    "payments_total": None,
    "reliability_cost": fixed.RELIABILITY_PAYMENTS,
    "review_cost": fixed.REVIEW_PAYMENTS,
    "actual_total_prize": fixed.PRIZE_PAYMENTS,
    "copilot_cost": fixed.COPILOT_PAYMENTS,
}


def attributes(ctx: LoadContext, names: list[str], only: DataFrame) -> DataFrame:
    chosen = {name: fixed.PROJECT_ATTRIBUTES[name] for name in names}
    rows = ctx.source("project_info").join(only, "project_id", "left_semi")
    return joins.pivot_attributes(rows, "project_id", chosen, "project_info_type_id")


def money_or_zero(name: str) -> Column:
    return F.coalesce(scalar.to_money(name), F.lit(0).cast("decimal(18,2)"))


def touched_projects(ctx: LoadContext) -> DataFrame:
    """Ids of projects with a change in any table that feeds the project table."""
    mark = ctx.mark()
    project, info = ctx.source("project"), ctx.source("project_info")
    versions = info.filter(F.col("project_info_type_id") == 1).select("project_id", scalar.to_long("value").alias("comp_vers_id")).join(
        ctx.source("comp_versions").select("comp_vers_id", "modify_date"), "comp_vers_id"
    )
    uploads = ctx.source("upload").select("upload_id", "project_id", "create_date", "modify_date").join(
        ctx.source("submission").filter(F.col("submission_type_id") == CONTEST_SUBMISSION).select(
            "upload_id", F.col("create_date").alias("s_create"), F.col("modify_date").alias("s_modify")
        ), "upload_id",
    )
    payments = ctx.source("payment").select(
        F.col("most_recent_detail_id").alias("payment_detail_id"), F.col("create_date").alias("p_create"), F.col("modify_date").alias("p_modify")
    ).join(
        ctx.source("payment_detail").filter(~F.col("payment_status_id").isin(*fixed.PAYMENT_INACTIVE)).select(
            "payment_detail_id", "component_project_id", "create_date", "date_modified"
        ), "payment_detail_id",
    )
    stamps = ["create_date", "modify_date"]
    keys = changes.changed_keys(
        [
            (project, "project_id", ["modify_date"]),
            (versions, "project_id", ["modify_date"]),
            (ctx.source("resource"), "project_id", stamps),
            (uploads, "project_id", [*stamps, "s_create", "s_modify"]),
            (ctx.source("project_result"), "project_id", stamps),
            (info.filter(F.col("project_info_type_id").isin(*WATCHED_ATTRIBUTES)), "project_id", stamps),
            (payments, "component_project_id", ["create_date", "date_modified", "p_create", "p_modify"]),
        ],
        mark, "project_id",
    )
    if changes.needs_migrated(ctx.hwm, ctx.options.get("migration_cutover", fixed.MIGRATION_CUTOVER)):
        ref = info.filter(F.col("project_info_type_id") == 2)
        for frame in (project, ref):
            keys = keys.unionByName(frame.filter(F.col("modify_user") != fixed.MIGRATION_USER).select("project_id"))
        keys = keys.distinct()
    return keys


def _phase_values() -> dict[str, Column]:
    """Phase dates of a project over its phase rows."""
    of = lambda kind, column: F.max(F.when(F.col("phase_type_id") == kind, F.col(column)))
    actual_or_planned = lambda kind, side: F.coalesce(of(kind, f"actual_{side}_time"), of(kind, f"scheduled_{side}_time"))
    closed = (F.col("phase_type_id") == REVIEW) & (F.col("phase_status_id") == 3)
    return {
        "posted": actual_or_planned(REGISTRATION, "start"),
        "submitby_date": of(SUBMISSION, "actual_end_time"),
        "checkpoint_start_date": actual_or_planned(CHECKPOINT, "start"),
        "checkpoint_end_date": actual_or_planned(CHECKPOINT_END, "end"),
        "registration_end_date": actual_or_planned(REGISTRATION, "end"),
        "scheduled_end_date": F.max("scheduled_end_time"),
        "review_end": F.max(F.when(closed, F.col("actual_end_time"))),
    }


def _submission_values() -> dict[str, Column]:
    status = F.col("submission_status_id")
    contest, checkpoint = (F.col("submission_type_id") == kind for kind in (CONTEST_SUBMISSION, CHECKPOINT_SUBMISSION))
    counts = {
        "num_submissions": contest & (status != 5),
        "num_valid_submissions": contest & status.isin(1, 3, 4),
        "num_submissions_passed_review": contest & status.isin(1, 4),
        "num_checkpoint_submissions": checkpoint & (status != 5),
        "num_valid_checkpoint_submissions": checkpoint & status.isin(1, 3, 4, 7),
    }
    return {n: aggregates.count_where(c) for n, c in counts.items()}


def _prize_values() -> dict[str, Column]:
    kind, amount, number = F.col("prize_type_id"), F.col("prize_amount"), F.col("number_of_submissions")
    return {
        "first_place_prize": F.sum(F.when((kind == PRIZE) & (F.col("place") == 1), amount)),
        "total_prize": F.sum(F.when(kind.isin(PRIZE, CHECKPOINT_PRIZE), number * amount)),
        "checkpoint_prize_number": F.sum(F.when(kind == CHECKPOINT_PRIZE, number)),
        "checkpoint_prize_amount": F.max(F.when(kind == CHECKPOINT_PRIZE, amount)),
    }


def project_children(ctx: LoadContext, only: DataFrame, names: list[str]) -> DataFrame:
    """Everything the child tables say about the given projects, one row per project with any child.

    Attributes, phases, resources, submissions, prizes, results and payments are cut down to
    these projects and grouped table by table. First rows (open phase, copilot, manager) are aggregates of their
    own: structs keep an aggregate from hashing its groups, and only few rows can be a first one. ``only`` is settled; rows of
    other projects are left out by its sieve, those that pass it by the join with the ids, so that rows are added up before they are exchanged.
    """
    return settle_alone(lambda: _project_children(ctx, only, names))


def _project_children(ctx: LoadContext, only: DataFrame, names: list[str]) -> DataFrame:
    wanted = joins.Sieve.of(only.select("project_id"))
    near = lambda table: wanted.rows(ctx.source(table), "project_id")
    chosen = {name: fixed.PROJECT_ATTRIBUTES[name] for name in names}
    renamed = {n: n if n in ("version_ref", "component_ref") else f"a_{n}" for n in names}
    phases, role = near("project_phase"), F.col("resource_role_id")
    named = ctx.source("resource_info").filter(F.col("resource_info_type_id") == 1).select("resource_id", scalar.to_long("value").alias("user"))
    resources = near("resource")
    led = settle(resources.filter(role == MANAGER).select("project_id", "resource_id"))
    managers = led.join(joins.Sieve.of(led.select("resource_id")).rows(named, "resource_id"), "resource_id").filter(~F.col("user").isin(*NO_MANAGER))
    uploads = settle(near("upload").select("upload_id", "project_id"))
    sent = ctx.source("submission").select("upload_id", "submission_type_id", "submission_status_id")
    first = lambda *columns: F.min(F.struct(*columns))
    submitted, costs = _submission_values(), aggregates.cost_columns(COST_CLASSES)
    parts = {
        "attribute": (
            near("project_info").filter(F.col("project_info_type_id").isin(*chosen.values())).select("project_id", "project_info_type_id", "value"),
            {renamed[n]: F.max(F.when(F.col("project_info_type_id") == kind, F.col("value"))) for n, kind in chosen.items()},
        ),
        "phase": (phases, _phase_values()),
        "open_phase": (phases.filter(F.col("phase_status_id") == 2), {"_open_phase": first("project_phase_id", "phase_type_id")}),
        "resource": (resources.filter(role.isin(SUBMITTER, COPILOT)), {"num_registrations": aggregates.count_where(role == SUBMITTER)}),
        "copilot": (resources.filter(role == COPILOT), {"_copilot_at": first(F.col("resource_id").alias("id"), F.col("user_id").alias("user"))}),
        "manager": (managers, {"_manager_at": first(F.col("resource_id").alias("id"), "user")}),
        "submission": (uploads.join(joins.Sieve.of(uploads.select("upload_id")).rows(sent, "upload_id"), "upload_id"), submitted),
        "prize": (near("prize"), _prize_values()),
        "result": (near("project_result"), {"avg_raw_score": F.avg("raw_score"), "avg_final_score": F.avg("final_score")}),
        "payment": (aggregates.payment_rows(ctx.source("payment"), ctx.source("payment_detail"), only=only), costs),
    }
    children = aggregates.join_children(only, parts, "project_id", zero=["num_registrations", *submitted, *costs], steps=True)
    fixes = aggregates.cutoff_max(
        phases, "project_id", F.col("actual_end_time"), (F.col("phase_type_id") == FINAL_FIX) & (F.col("phase_status_id") == 3),
        F.coalesce("actual_start_time", "scheduled_start_time"), F.col("phase_type_id") == APPROVAL, "fix_end",
    )
    children = children.join(fixes, "project_id", "left").withColumns({
        "_manager": F.col("_manager_at.user"), "_copilot": F.col("_copilot_at.user"), "review_phase_id": F.col("_open_phase.phase_type_id"),
    })
    return joins.lookup(children, ctx.source("phase_type_lu"), {"review_phase_id": "phase_type_id"}, {"review_phase_name": "name"}, "left")


def prize_totals(ctx: LoadContext, base: DataFrame, only: DataFrame) -> DataFrame:
    prizes = ctx.source("prize").join(only, "project_id", "left_semi")
    values = _prize_values()
    return aggregates.with_child_values(base, prizes, "project_id", values).withColumns({c: scalar.or_zero(c) for c in values})


def component_names(ctx: LoadContext, refs: DataFrame) -> DataFrame:
    """Component, version and category of rows with both references."""
    versions = ctx.source("comp_versions").select(
        F.col("comp_vers_id").alias("_vers"), F.col("version").alias("version_id"), "version_text", "suspended_ind"
    )
    components = ctx.source("comp_catalog").select("component_id", "component_name", F.col("root_category_id").alias("category_id"))
    categories = ctx.source("categories").select(
        "category_id", F.col("category_name").alias("category_desc"), F.col("viewable").alias("viewable_category_ind")
    )
    return (
        refs.withColumns({"_vers": scalar.to_long("version_ref"), "component_id": scalar.to_long("component_ref")})
        .join(versions, "_vers").join(components, "component_id").join(categories, "category_id")
    )


def kind_names(ctx: LoadContext, rows: DataFrame) -> DataFrame:
    """Names of status and category."""
    states = ctx.source("project_status_lu").select("project_status_id", F.col("name").alias("status_desc"))
    kinds = ctx.source("project_category_lu").select("project_category_id", F.col("name").alias("project_category_name"), "project_type_id")
    return rows.join(states, "project_status_id").join(kinds, "project_category_id")


def component_side(ctx: LoadContext, base: DataFrame) -> DataFrame:
    """Component, version, category, status and category names of projects with both references."""
    return kind_names(ctx, component_names(ctx, base))


def people(ctx: LoadContext, rows: DataFrame, known: dict[str, str]) -> DataFrame:
    """Known users under new names: ``known`` maps a name to the column that holds an id."""
    users = ctx.source("common.user").select("user_id")
    for name, column in known.items():
        rows = joins.lookup(rows, users, {column: "user_id"}, {name: "user_id"}, "left")
    return rows


def project_rows(ctx: LoadContext, only: DataFrame, categories: Column) -> DataFrame:
    """All columns of the project table for the given project ids.

    Every child table is cut down to these ids before it is grouped.
    """
    project = eligible(ctx, ctx.source("project").filter(categories).join(only, "project_id", "left_semi"))
    names = [
        "version_ref", "component_ref", "forum", "complete_text", "rating_text", "winner", "run_flag", "run_points", "admin_fee",
        "billing", "review_cost", "review_cost_more", "reliability_cost", "reliability_flag", "copilot_cost", "viewable_flag",
        "fee_percentage", "launcher", "task_flag",
    ]
    # Settled, as the columns below are computed from it over and over.
    children = project_children(ctx, only, names)
    # There is one row of children per project: what its ids refer to is looked up with the ids alone, so the
    # wide rows are exchanged by project only.
    named = component_names(ctx, children.select("project_id", "version_ref", "component_ref")).drop("version_ref", "component_ref")
    staff = people(
        ctx, children.select("project_id", scalar.to_long("a_launcher").alias("_launcher"), "_manager", "_copilot"),
        {"challenge_launcher": "_launcher", "challenge_manager": "_manager", "copilot": "_copilot"},
    ).drop("_launcher", "_manager", "_copilot")
    project = people(ctx, project, {"challenge_creator": "create_user"})
    rows = project.join(children.drop("_manager", "_copilot"), "project_id").join(named, "project_id").join(staff, "project_id")
    rows = kind_names(ctx, rows).withColumns({c: scalar.or_zero(c) for c in _prize_values()})
    rows = joins.exists_flag(
        rows, ctx.source("contest_eligibility").withColumnRenamed("contest_id", "project_id"), ["project_id"], "is_private"
    )
    rows = with_stage(ctx, rows, "posted")

    on = F.col("a_run_flag") == "On"
    run_points = F.when(on, money_or_zero("a_run_points")).otherwise(0)
    completed = F.col("project_status_id") == fixed.STATUS_COMPLETED
    by_fixes = (F.col("project_type_id") != STUDIO_TYPE) & ~F.col("project_category_id").isin(*REVIEWED_CATEGORIES)
    run_flag = F.coalesce(F.substring("a_run_flag", 1, 4), F.lit("On"))
    viewable = F.when(F.col("a_viewable_flag").isNotNull(), scalar.flag("a_viewable_flag", "true"))
    estimate = F.when(F.col("a_reliability_flag") == "true", money_or_zero("a_reliability_cost")).otherwise(0)
    rows = rows.withColumn(
        "contest_prizes_total", scalar.or_zero("payments_total") + F.when(completed, run_points).otherwise(0)
    )
    return rows.withColumns({
        **{c: scalar.or_zero(c) for c in COST_CLASSES if c != "payments_total"},
        "phase_id": F.col("project_category_id") + fixed.PHASE_OFFSET,
        "phase_desc": F.col("project_category_name"),
        "level_id": F.lit(1),
        "status_id": F.col("project_status_id"),
        "posting_date": F.to_date("posted").cast("timestamp_ntz"),
        "complete_date": scalar.parse_timestamp("a_complete_text"),
        "rating_date": scalar.parse_timestamp("a_rating_text"),
        "review_phase_id": scalar.or_zero("review_phase_id"),
        "winner_id": scalar.to_long(F.substring("a_winner", 1, 20)),
        "digital_run_ind": scalar.flag(run_flag, "On", "Yes"),
        "admin_fee": scalar.admin_fee(
            F.col("project_status_id"), money_or_zero("a_admin_fee"), money_or_zero("a_fee_percentage"), F.col("contest_prizes_total")
        ),
        "client_project_id": scalar.billing_id("a_billing"),
        "duration": scalar.duration_minutes("posted", F.when(by_fixes, F.col("fix_end")).otherwise(F.col("review_end"))),
        "last_modification_date": ctx.now(),
        "dr_points": run_points,
        "forum_id": scalar.to_long("a_forum"),
        "submission_viewable": viewable,
        "estimated_reliability_cost": estimate,
        "estimated_review_cost": money_or_zero("a_review_cost") + money_or_zero("a_review_cost_more"),
        "estimated_copilot_cost": money_or_zero("a_copilot_cost"),
        "estimated_admin_fee": money_or_zero("a_admin_fee"),
        "task_ind": scalar.or_zero(scalar.to_long("a_task_flag")),
    })


def with_stage(ctx: LoadContext, rows: DataFrame, posted: str) -> DataFrame:
    """Stage whose first and last day enclose the posting day; null without one.

    Stages are spread over their days first, which makes this an equality on
    the day with at most one row per calendar day.
    """
    days = lambda name, alias: ctx.target("calendar").select(
        F.col("calendar_id").alias(name), F.to_date(F.col("date")).alias(alias)
    )
    spans = ctx.target("stage").join(days("start_calendar_id", "_from"), "start_calendar_id").join(
        days("end_calendar_id", "_to"), "end_calendar_id"
    ).filter("_from <= _to")
    # Settled, so that Spark knows its size before it plans an exchange of the wide rows.
    by_day = settle(spans.select("stage_id", F.explode(F.sequence("_from", "_to")).alias("_day")).groupBy("_day").agg(
        F.min("stage_id").alias("stage_id")
    ))
    return rows.join(by_day, F.to_date(rows[posted]) == by_day["_day"], "left").drop("_day")


def refreshed(ctx: LoadContext, target: DataFrame) -> DataFrame:
    """Columns set on the whole table after a load: fulfillment and start day."""
    day = joins.calendar_lookup(target, ctx.target("calendar"), {"_day_id": "posting_date"})
    return merge.set_where(
        day,
        F.col("complete_date").isNotNull() & (F.col("tc_direct_project_id") > 0) & F.col("posting_date").isNotNull(),
        fulfillment=F.when(F.col("status_id") == fixed.STATUS_COMPLETED, 1).otherwise(0).cast("decimal(10,2)"),
        start_date_calendar_id=F.col("_day_id"),
    ).select(*target.columns)


def split_versions(rows: DataFrame) -> DataFrame:
    """Rows to write: not deleted and below the version limit."""
    return rows.filter((F.col("project_status_id") != fixed.STATUS_DELETED) & (F.col("version_id") <= MAX_VERSION))


@load("project", 2)
def project(ctx: LoadContext) -> dict[str, Write]:
    """Projects with a change anywhere; deleted ones leave the table."""
    rows = project_rows(ctx, settle(touched_projects(ctx)), F.col("project_category_id").isin(*fixed.LOAD_CATEGORIES))
    rows = settle(written(ctx, rows))
    gone = rows.filter(F.col("project_status_id") == fixed.STATUS_DELETED).select("project_id")
    kept = split_versions(rows).drop("project_status_id")
    # Deleted ones leave both sides first: the wide rows are exchanged once for that and for the upsert.
    target = merge.delete_keys(ctx.target("project"), gone, "project_id")
    target = merge.upsert(target, merge.delete_keys(kept, gone, "project_id"), ["project_id"], settled=True)
    return {"project": Write(refreshed(ctx, target))}


def written(ctx: LoadContext, rows: DataFrame) -> DataFrame:
    """The columns of the project table that the rows have, plus the state that routes them."""
    have = [c for c in ctx.target("project").columns if c in rows.columns]
    return rows.select(*have, "project_status_id")


# Columns added to the project table later, with the projects each group is filled for.
LATE_COLUMNS = {
    "people": (
        ["challenge_creator", "challenge_manager", "challenge_launcher", "copilot", "checkpoint_start_date", "checkpoint_end_date"],
        lambda: F.lit(True),
    ),
    "costs": (
        ["review_cost", "registration_end_date", "scheduled_end_date", "checkpoint_prize_amount", "checkpoint_prize_number",
         "dr_points", "reliability_cost", "forum_id", "submission_viewable", "is_private"],
        lambda: F.col("project_status_id") == fixed.STATUS_COMPLETED,
    ),
    "estimates": (
        ["estimated_review_cost", "estimated_reliability_cost", "estimated_copilot_cost", "estimated_admin_fee",
         "actual_total_prize", "copilot_cost"],
        lambda: F.col("project_category_id").isin(*fixed.LOAD_CATEGORIES),
    ),
}


@load("project_backfill", 2)
def project_backfill(ctx: LoadContext) -> dict[str, Write]:
    """Fill column groups of existing projects while no row has a value in them.

    The estimated review cost of this fill is the first of its two parts only.
    """
    target = ctx.target("project")
    empty = [group for group in LATE_COLUMNS.values() if merge.is_unfilled(target, group[0][0])]
    if not empty:
        return {}
    rows = project_rows(ctx, settle(target.select("project_id")), F.lit(True))
    rows = rows.withColumn("_first_estimate", money_or_zero("a_review_cost"))
    names = dict.fromkeys(c for columns, _ in empty for c in columns)
    source = settle(rows.select("project_id", "project_status_id", "project_category_id", "_first_estimate", *names))
    for columns, which in empty:
        part = source.filter(which())
        if "estimated_review_cost" in columns:
            part = part.withColumn("estimated_review_cost", F.col("_first_estimate"))
        target = merge.upsert_columns(target, part, ["project_id"], columns)
    return {"project": Write(target)}


@load("marathon_match", 2)
def marathon_match(ctx: LoadContext) -> dict[str, Write]:
    """Completed matches as projects; their dates, registrations and submissions come from the round."""
    target = ctx.target("project")
    matches = ctx.source("project").filter(
        (F.col("project_category_id") == MATCH_CATEGORY) & (F.col("project_status_id") == fixed.STATUS_COMPLETED)
    )
    only = settle(eligible(ctx, matches).select("project_id"))
    if not target.filter(F.col("project_category_id") == MATCH_CATEGORY).isEmpty():
        only = settle(only.join(touched_matches(ctx, only), "project_id", "left_semi"))
    rows = matches.join(only, "project_id", "left_semi")
    names = ["version_ref", "component_ref", "complete_text", "admin_fee", "billing", "match_ref", "fee_percentage"]
    wide = attributes(ctx, names, only).withColumnsRenamed({n: f"a_{n}" for n in names if n not in ("version_ref", "component_ref")})
    rows = component_side(ctx, rows.join(wide, "project_id")).withColumn("round_id", scalar.to_long("a_match_ref")).filter("round_id IS NOT NULL")
    rows = settle(rows)
    rounds = rows.select("round_id").distinct()

    registered = ctx.source("round_registration").join(rounds, "round_id", "left_semi")
    rows = aggregates.with_child_values(rows, registered, "round_id", {"num_registrations": F.count(F.lit(1))}, zero=["num_registrations"])
    sent = ctx.source("long_component_state").join(rounds, "round_id", "left_semi").join(
        ctx.source("long_submission").filter(F.col("example") == 0), "long_component_state_id"
    )
    rows = aggregates.with_child_values(rows, sent, "round_id", {"num_submissions": F.count(F.lit(1))}, zero=["num_submissions"])
    segment = lambda number, column: F.max(F.when(F.col("segment_id") == number, F.col(column)))
    rows = aggregates.with_child_values(
        rows, ctx.source("round_segment").join(rounds, "round_id", "left_semi"), "round_id",
        {"posted": segment(1, "start_time"), "submitby_date": segment(2, "end_time"), "_done": segment(4, "end_time")},
    )
    latest = ctx.source("payment").select(F.col("most_recent_detail_id").alias("payment_detail_id")).join(
        ctx.source("payment_detail").filter(
            (F.col("installment_number") == 1) & F.col("component_project_id").isNull() & ~F.col("payment_status_id").isin(*fixed.PAYMENT_EXCLUDED)
        ).join(rounds.withColumnRenamed("round_id", "algorithm_round_id"), "algorithm_round_id", "left_semi"), "payment_detail_id",
    )
    rows = aggregates.with_child_values(
        rows, latest, "round_id", {"contest_prizes_total": F.sum("total_amount")}, child_key="algorithm_round_id"
    ).withColumn("contest_prizes_total", scalar.or_zero("contest_prizes_total"))
    rows = prize_totals(ctx, rows, only)
    rows = rows.withColumns({
        "phase_id": F.col("project_category_id") + fixed.PHASE_OFFSET,
        "phase_desc": F.col("project_category_name"),
        "level_id": F.lit(1),
        "status_id": F.col("project_status_id"),
        "posting_date": F.to_date("posted").cast("timestamp_ntz"),
        "complete_date": scalar.parse_timestamp("a_complete_text"),
        "admin_fee": scalar.admin_fee(
            F.col("project_status_id"), money_or_zero("a_admin_fee"), money_or_zero("a_fee_percentage"), F.col("contest_prizes_total")
        ),
        "client_project_id": scalar.billing_id("a_billing"),
        "duration": scalar.duration_minutes("posted", "_done"),
        "last_modification_date": ctx.now(),
    })
    kept = settle(split_versions(written(ctx, rows)).drop("project_status_id", "checkpoint_prize_amount", "checkpoint_prize_number", "suspended_ind"))
    return {"project": Write(refreshed(ctx, merge.upsert(target, kept, ["project_id"])))}


def touched_matches(ctx: LoadContext, matches: DataFrame) -> DataFrame:
    """Ids of the given matches with a change in the project, its version, its attributes or its payments.

    Every table is cut down to these matches, or to their rounds, before it is joined.
    """
    mark = ctx.mark()
    info = ctx.source("project_info").join(matches, "project_id", "left_semi")
    value = scalar.to_long("value")
    versions = info.filter(F.col("project_info_type_id") == 1).select("project_id", value.alias("comp_vers_id")).join(
        ctx.source("comp_versions").select("comp_vers_id", "modify_date"), "comp_vers_id"
    )
    by_round = settle(info.filter(F.col("project_info_type_id") == fixed.PROJECT_ATTRIBUTES["match_ref"]).select("project_id", value.alias("round_id")))
    details = ctx.source("payment_detail").filter(~F.col("payment_status_id").isin(*fixed.PAYMENT_INACTIVE)).select(
        "payment_detail_id", F.col("algorithm_round_id").alias("round_id"), "create_date", "date_modified"
    ).join(by_round.select("round_id"), "round_id", "left_semi")
    paid = ctx.source("payment").select(
        F.col("most_recent_detail_id").alias("payment_detail_id"), F.col("create_date").alias("p_create"), F.col("modify_date").alias("p_modify")
    ).join(details, "payment_detail_id")
    rounds = changes.changed_keys([(paid, "round_id", ["create_date", "date_modified", "p_create", "p_modify"])], mark, "round_id")
    return changes.changed_keys(
        [
            (ctx.source("project").join(matches, "project_id", "left_semi"), "project_id", ["modify_date"]),
            (versions, "project_id", ["modify_date"]),
            (info.filter(F.col("project_info_type_id").isin(*MATCH_ATTRIBUTES)), "project_id", ["create_date", "modify_date"]),
        ],
        mark, "project_id",
    ).unionByName(by_round.join(rounds, "round_id", "left_semi").select("project_id")).distinct()


def _children(ctx: LoadContext, table: str, rows: DataFrame) -> dict[str, Write]:
    """Replace the rows of changed projects; a first run takes all."""
    target = ctx.target(table)
    if changes.is_first_run(target):
        return {table: Write(rows.select(*target.columns))}
    changed = ctx.source("project").filter(ctx.changed("create_date", "modify_date")).select("project_id")
    return {table: Write(merge.replace_by_key(target, rows.join(changed, "project_id", "left_semi"), ["project_id"]))}


@load("project_platform", 3)
def project_platform(ctx: LoadContext) -> dict[str, Write]:
    rows = joins.lookup(
        ctx.source("project_platform"), ctx.source("project_platform_lu"), {"project_platform_id": "project_platform_id"}, {"name": "name"}
    ).join(ctx.source("project").select("project_id"), "project_id", "left_semi")
    return _children(ctx, "project_platform", rows)


@load("project_technology", 3)
def project_technology(ctx: LoadContext) -> dict[str, Write]:
    versions = ctx.source("project_info").filter(F.col("project_info_type_id") == 1).select("project_id", scalar.to_long("value").alias("comp_vers_id"))
    used = ctx.source("comp_technology").withColumnRenamed("technology_type_id", "project_technology_id")
    rows = joins.lookup(
        versions.join(used, "comp_vers_id"), ctx.source("technology_types"), {"project_technology_id": "technology_type_id"}, {"name": "technology_name"}
    ).join(ctx.source("project").select("project_id"), "project_id", "left_semi")
    return _children(ctx, "project_technology", rows)
