"""Loads of lookups and dimensions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.functions.scalar import header_cut, or_zero, pad_code, text_or_empty
from loadstone.operators import changes, joins, sequences
from loadstone.plans.core import LoadContext, eligible, stamped, upsert_load


def _changed(ctx: LoadContext, table: str, stamp: str = "modify_date") -> DataFrame:
    return ctx.source(table).filter(changes.is_changed(ctx.mark(), stamp))


@upsert_load("contest", 1, ["contest_id"])
def contest(ctx):
    rows = joins.lookup(
        _changed(ctx, "contest"), ctx.source("contest_type_lu"), {"contest_type_id": "contest_type_id"}, {"contest_type_desc": "contest_type_desc"}
    )
    return joins.lookup(
        rows, ctx.source("project_category_lu"), {"project_category_id": "project_category_id"}, {"project_category_name": "name"}
    ).withColumnsRenamed({"start_date": "contest_start_timestamp", "end_date": "contest_end_timestamp"})


@upsert_load("contest_prize", 1, ["contest_prize_id"])
def contest_prize(ctx):
    return joins.lookup(
        _changed(ctx, "contest_prize"), ctx.source("prize_type_lu"), {"prize_type_id": "prize_type_id"}, {"prize_type_desc": "prize_type_desc"}
    )


@upsert_load("track", 1, ["track_id"])
def track(ctx):
    rows = joins.lookup(
        _changed(ctx, "track", "create_date"), ctx.source("track_status_lu"),
        {"track_status_id": "track_status_id"}, {"track_status_desc": "track_status_desc"},
    )
    return joins.lookup(rows, ctx.source("track_type_lu"), {"track_type_id": "track_type_id"}, {"track_type_desc": "track_type_desc"})


@upsert_load("track_contest", 1, ["track_contest_id"])
def track_contest(ctx):
    return joins.lookup(
        _changed(ctx, "track_contest", "create_date"), ctx.source("track_contest_type_lu"),
        {"track_contest_type_id": "track_contest_type_id"}, {"track_contest_type_desc": "track_contest_type_desc"},
    )


@upsert_load("coder", 1, ["coder_id"], checked=True)
def coder(ctx):
    """Users touched in any of their tables, with address, phones and picture where there is one."""
    user, address, phone = ctx.source("common.user"), ctx.source("common.address"), ctx.source("common.phone")
    xref, image = ctx.source("common.user_address_xref"), ctx.source("image")
    pictures = ctx.source("coder_image_xref").join(image, "image_id")
    touched = changes.changed_keys(
        [
            (ctx.source("coder"), "coder_id", ["modify_date"]),
            (xref.join(address.select("address_id", "modify_date"), "address_id"), "user_id", ["modify_date"]),
            (phone, "user_id", ["modify_date"]),
            (pictures, "coder_id", ["modify_date"]),
            (ctx.source("common.email"), "user_id", ["modify_date"]),
            (user, "user_id", ["modify_date"]),
        ],
        ctx.mark(), "coder_id",
    )
    homes = xref.join(
        address.filter(F.col("address_type_id") == 2).select(
            "address_id", "state_code", "country_code", "address1", "address2", "city", "zip"
        ), "address_id",
    ).drop("address_id").withColumnRenamed("user_id", "coder_id")
    primary = F.col("primary_ind") == 1
    numbers = lambda kind, name: phone.filter((F.col("phone_type_id") == kind) & primary).select(
        F.col("user_id").alias("coder_id"), F.col("phone_number").alias(name)
    )
    shown = pictures.filter((F.col("image_type_id") == 1) & (F.col("display_flag") == 1)).select("coder_id", F.col("image_id").alias("image"))
    mail = ctx.source("common.email").filter(primary).select(F.col("user_id").alias("coder_id"), F.col("address").alias("email"))
    rows = (
        ctx.source("coder").drop("modify_date").join(touched, "coder_id", "left_semi")
        .join(user.withColumnRenamed("user_id", "coder_id"), "coder_id")
        .join(mail, "coder_id")
    )
    for side in (homes, numbers(2, "home_phone"), numbers(1, "work_phone"), shown):
        rows = joins.left_where(rows, side, ["coder_id"])
    return rows.withColumns({
        **{c: text_or_empty(c) for c in ("state_code", "address1", "address2", "city", "zip")},
        "country_code": pad_code("country_code"),
        "comp_country_code": pad_code("comp_country_code"),
        "image": or_zero("image"),
    })


@upsert_load("client_project_dim", 1, ["billing_project_id"])
def client_project_dim(ctx):
    """Clients with their billing projects."""
    client = ctx.source("time.client").select(
        "client_id", F.col("name").alias("client_name"), F.col("creation_date").alias("client_create_date"),
        F.col("modification_date").alias("client_modification_date"), "cmc_account_id", "customer_number",
    )
    project = ctx.source("time.project").select(
        F.col("project_id").alias("billing_project_id"), F.col("name").alias("project_name"),
        F.col("creation_date").alias("project_create_date"), F.col("modification_date").alias("project_modification_date"),
        F.col("po_box_number").alias("billing_account_code"), F.col("active").alias("billing_account_status"),
        F.col("start_date").alias("billing_account_start_date"), F.col("end_date").alias("billing_account_end_date"),
    )
    xref = ctx.source("time.client_project").select("client_id", F.col("project_id").alias("billing_project_id"), F.col("modification_date").alias("_linked"))
    rows = xref.join(client, "client_id").join(project, "billing_project_id")
    return rows.filter(ctx.changed("client_modification_date", "project_modification_date", "_linked")).withColumn(
        "client_project_id", F.col("billing_project_id")
    )


@upsert_load("direct_project_dim", 1, ["direct_project_id"])
def direct_project_dim(ctx):
    accounts = ctx.source("corporate.direct_project_account").groupBy("project_id").agg(F.max("billing_account_id").alias("billing_project_id"))
    rows = _changed(ctx, "tc_direct_project").join(accounts, "project_id", "left")
    return rows.select(
        F.col("project_id").alias("direct_project_id"), "name", "description", "project_status_id",
        F.col("create_date").alias("project_create_date"), F.col("modify_date").alias("project_modification_date"),
        or_zero("billing_project_id").alias("billing_project_id"),
    )


@upsert_load("evaluation_lu", 1, ["evaluation_id"])
def evaluation_lu(ctx):
    rows = ctx.source("evaluation").withColumnsRenamed({"evaluation_name": "evaluation_desc", "value": "evaluation_value"})
    return joins.lookup(
        rows, ctx.source("evaluation_type"), {"evaluation_type_id": "evaluation_type_id"}, {"evaluation_type_desc": "eval_type_name"}, "left"
    )


@upsert_load("event", 1, ["event_id"])
def event(ctx):
    return _changed(ctx, "event").withColumnRenamed("event_desc", "event_name")


@upsert_load("event_registration", 1, ["event_id", "user_id"])
def event_registration(ctx):
    return _changed(ctx, "event_registration").withColumn("eligible_ind", or_zero("eligible_ind"))


@upsert_load("user_event_xref", 1, ["event_id", "user_id"])
def user_event_xref(ctx):
    return _changed(ctx, "user_event_xref")


@upsert_load("season", 1, ["season_id"])
def season(ctx):
    """Seasons from the first start to the last end of their stages."""
    spans = ctx.source("stage").groupBy("season_id").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
    rows = _changed(ctx, "season").join(spans, "season_id", "left")
    return joins.calendar_lookup(
        rows, ctx.target("calendar"), {"start_calendar_id": "start_date", "end_calendar_id": "end_date"}, strict=True
    ).withColumns({c: or_zero(c) for c in ("rookie_competition_ind", "next_rookie_season_id")})


@upsert_load("stage", 1, ["stage_id"])
def stage(ctx):
    return joins.calendar_lookup(
        _changed(ctx, "stage"), ctx.target("calendar"), {"start_calendar_id": "start_date", "end_calendar_id": "end_date"}, strict=True
    )


@upsert_load("scorecard_template", 1, ["scorecard_template_id"])
def scorecard_template(ctx):
    rows = stamped(ctx.source("scorecard"), "s", F.col("scorecard_id").alias("scorecard_template_id"), "scorecard_type_id")
    types = stamped(ctx.source("scorecard_type_lu"), "t", "scorecard_type_id", F.col("name").alias("scorecard_type_desc"))
    return rows.join(types, "scorecard_type_id").filter(ctx.changed("m_s", "m_t", users=["w_s", "w_t"]))


@upsert_load("scorecard_question", 1, ["scorecard_question_id"])
def scorecard_question(ctx):
    """Questions with their place in the scorecard and a short header."""
    question = stamped(
        ctx.source("scorecard_question"), "q", "scorecard_question_id", F.col("scorecard_section_id").alias("section_id"),
        F.concat("description", "guideline").alias("question_text"), F.col("weight").alias("question_weight"),
        (F.col("sort") + 1).alias("_question"),
    )
    section = stamped(
        ctx.source("scorecard_section"), "s", F.col("scorecard_section_id").alias("section_id"), F.col("scorecard_group_id").alias("section_group_id"),
        F.col("name").alias("section_desc"), F.col("weight").alias("_section_weight"), (F.col("sort") + 1).alias("_section"),
    )
    group = stamped(
        ctx.source("scorecard_group"), "g", F.col("scorecard_group_id").alias("section_group_id"), F.col("scorecard_id").alias("scorecard_template_id"),
        F.col("name").alias("section_group_desc"), F.col("weight").alias("_group_weight"), (F.col("sort") + 1).alias("_group"),
    )
    rows = question.join(section, "section_id").join(group, "section_group_id")
    rows = rows.filter(ctx.changed("m_q", "m_s", "m_g", users=["w_q", "w_s", "w_g"]))
    numbered = sequences.number_in_group(
        rows, ["scorecard_template_id"], ["_group", "_section", "_question", "scorecard_question_id"], "sort"
    )
    return numbered.withColumns({
        "section_weight": F.col("_section_weight") * F.col("_group_weight") / 100,
        "question_desc": F.concat_ws(".", "_group", "_section", "_question"),
        "question_header": header_cut("question_text"),
    })


@upsert_load("user_contest_prize", 1, ["contest_id", "user_id"])
def user_contest_prize(ctx):
    prizes = _changed(ctx, "contest_prize").join(ctx.source("prize_type_lu").select("prize_type_id"), "prize_type_id", "left_semi")
    return ctx.source("user_contest_prize").join(prizes, "contest_prize_id").withColumnsRenamed(
        {"prize_desc": "prize_description", "payment": "prize_payment"}
    )


@upsert_load("royalty", 1, ["royalty_date", "user_id"], update=["amount", "description"])
def royalty(ctx):
    return _changed(ctx, "royalty")


@upsert_load("user_reliability", 1, ["user_id", "phase_id"])
def user_reliability(ctx):
    return _changed(ctx, "user_reliability").withColumn("rating", or_zero("rating"))


def _plain(ctx: LoadContext, table: str, numbers: list[str]) -> DataFrame:
    return ctx.source(f"connect.{table}").withColumns({c: or_zero(c) for c in numbers})


@upsert_load("projects", 1, ["id"])
def projects(ctx):
    return _plain(
        ctx, "projects", ["directProjectId", "billingAccountId", "estimatedPrice", "actualPrice", "createdBy", "updatedBy"]
    )


@upsert_load("project_members", 1, ["id"])
def project_members(ctx):
    return _plain(ctx, "project_members", ["userId", "createdBy", "updatedBy"]).withColumn(
        "isPrimary", F.coalesce("isPrimary", F.lit(False))
    )


@upsert_load("contest_project_xref", 3, ["contest_id", "project_id"])
def contest_project_xref(ctx):
    """Contests of projects that have results."""
    project = eligible(ctx, ctx.source("project").select("project_id", F.col("modify_date").alias("_changed")))
    rows = ctx.source("contest_project_xref").join(project, "project_id")
    return rows.filter(ctx.changed("_changed", "create_date")).join(
        ctx.source("project_result").select("project_id"), "project_id", "left_semi"
    )


REVIEW_CATEGORY, REVIEW_LINK = 27, 3


def _spec_links(ctx: LoadContext) -> DataFrame:
    links = ctx.source("linked_project_xref").filter(F.col("link_type_id") == REVIEW_LINK)
    found = joins.linked(
        ctx.source("project").select("project_id", "project_category_id"), links, "project_id", "source_project_id", "dest_project_id",
        {"spec_review_project_id": "project_id"}, F.col("project_category_id") == REVIEW_CATEGORY,
    )
    return found.join(ctx.target("project").select("project_id"), "project_id", "left_semi")


@upsert_load("project_spec_review_xref", 3, ["project_id"])
def project_spec_review_xref(ctx):
    """Specification reviews of projects the warehouse has."""
    return _spec_links(ctx)


