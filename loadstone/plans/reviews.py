"""Loads of reviews, appeals, responses and submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.functions.scalar import evaluation_id, path_prefix, ratio_part, success_flag, text_or_empty
from loadstone.operators import changes, joins, merge, sequences
from loadstone.operators.aggregates import tri_state_count, with_child_values
from loadstone.plans.core import (
    LoadContext, Write, change_set, changed_below, flagged, load, loadable, only_keys, review_changed, reviews, submissions, touched_reviews,
    touched_submissions, upsert_load, user_of,
)
from loadstone.session import settle, settle_alone

# Comment types and question types.
APPEAL, APPEAL_RESPONSE = 4, 5
TEST_CASE = 3
RATED_QUESTIONS = (1, 2, 4)
# Resource roles of reviewers and screeners.
REVIEWERS, SCREENERS, ALL_REVIEWERS = (4, 5, 6, 7), (2, 3), (2, 3, 4, 5, 6, 7)
# Fixed value: state of a deleted submission.
DELETED = 5


def items(ctx: LoadContext, roles, *more: str, results: bool = False, asked: DataFrame | None = None) -> DataFrame:
    """Review items with their review, of reviews with a change in it or in the tables tagged ``more``.

    Settled. ``asked`` are the questions wanted, where not all are: few items and reviews have to be looked at then.
    """
    return settle_alone(lambda: _items(ctx, roles, more, results, asked))


def _items(ctx, roles, more, results, asked) -> DataFrame:
    only = touched_reviews(ctx, *more)
    rows = flagged(ctx, only_keys(ctx.source("review_item"), only, "review_id"), "ri", "review_item_id", "review_id", "scorecard_question_id", "answer")
    among = None
    if asked is not None:
        rows = joins.Sieve.of(asked.select("scorecard_question_id")).rows(rows, "scorecard_question_id")
        among = joins.Sieve.of(settle(rows.select("review_id")))
    below = changed_below(ctx, *more) if only is None and ctx.hwm is not None else None
    found = reviews(ctx, roles, only, results, below, among).drop(
        "submission_id", "review_resource_id", "scorecard_template_id", "score", "initial_score"
    )
    rows = joins.Sieve.of(found.select("review_id")).rows(rows, "review_id")
    return rows.join(found, "review_id").withColumnRenamed("review_id", "scorecard_id")


def on_items(rows: DataFrame, found: DataFrame, own: Column | None = None, changed: Column | None = None) -> DataFrame:
    """Comments that may be on the items; where ``changed`` is given, those that meet ``own`` and those on items that meet ``changed``."""
    ids = (found if changed is None else found.filter(changed)).select("review_item_id")
    sieve = joins.Sieve.of(ids)
    return sieve.rows(rows, "review_item_id") if own is None else joins.passing(rows, own, [("review_item_id", sieve)])


def comments(ctx: LoadContext, tag: str, *kinds: int) -> DataFrame:
    return flagged(
        ctx, ctx.source("review_item_comment").filter(F.col("comment_type_id").isin(*kinds)),
        tag, "review_item_comment_id", "review_item_id", "comment_type_id", "content", "extra_info",
    )


def responses(ctx: LoadContext) -> DataFrame:
    """Answers to appeals under their own names."""
    return comments(ctx, "resp", APPEAL_RESPONSE).select(
        "review_item_id", F.col("content").alias("resp_content"), F.col("extra_info").alias("resp_info"), "c_resp"
    )


def questions(ctx: LoadContext) -> DataFrame:
    return flagged(ctx, ctx.source("scorecard_question"), "sq", "scorecard_question_id", "scorecard_question_type_id")


@upsert_load("appeal", 4, ["appeal_id"])
def appeal(ctx):
    def found():
        item = items(ctx, REVIEWERS, "ric", "ri")
        rows = on_items(comments(ctx, "ric", APPEAL), item, F.col("c_ric"), review_changed("ri")).join(item, "review_item_id")
        return rows.filter(review_changed("ric", "ri")).join(questions(ctx), "scorecard_question_id")

    rows = settle_alone(found)
    rows = joins.left_where(rows, on_items(responses(ctx), rows), ["review_item_id"])
    kind = F.col("scorecard_question_type_id")
    return rows.select(
        F.col("review_item_comment_id").alias("appeal_id"), "scorecard_question_id", "scorecard_id", "user_id", "reviewer_id", "project_id",
        evaluation_id(kind, "resp_info").alias("raw_evaluation_id"), evaluation_id(kind, "answer").alias("final_evaluation_id"),
        text_or_empty("content").alias("appeal_text"), text_or_empty("resp_content").alias("appeal_response"),
        success_flag("extra_info").alias("successful_ind"),
    )


@upsert_load("testcase_appeal", 4, ["appeal_id"])
def testcase_appeal(ctx):
    asked = settle(questions(ctx).filter(F.col("scorecard_question_type_id") == TEST_CASE))

    def found():
        item = items(ctx, REVIEWERS, "ric", "ri", "sq", "resp", results=True, asked=asked)
        return on_items(comments(ctx, "ric", APPEAL), item).join(item, "review_item_id").join(asked, "scorecard_question_id")

    rows = settle_alone(found)
    rows = rows.join(on_items(responses(ctx), rows), "review_item_id")
    rows = rows.filter(review_changed("ric", "ri", "sq", "resp"))
    parts = {
        f"{side}_num_{name}": ratio_part(text, part, checked=False)
        for side, text in (("raw", "resp_info"), ("final", "answer"))
        for part, name in ((1, "passed"), (2, "tests"))
    }
    return rows.select(
        F.col("review_item_comment_id").alias("appeal_id"), "scorecard_question_id", "scorecard_id", "user_id", "reviewer_id", "project_id",
        *[value.alias(name) for name, value in parts.items()],
        F.col("content").alias("appeal_text"), F.col("resp_content").alias("appeal_response"),
        success_flag("extra_info").alias("successful_ind"),
    )


@upsert_load("testcase_response", 4, ["scorecard_question_id", "scorecard_id"])
def testcase_response(ctx):
    asked = settle(questions(ctx).filter(F.col("scorecard_question_type_id") == TEST_CASE))
    rows = items(ctx, REVIEWERS, "ri", "sq", asked=asked).join(asked, "scorecard_question_id")
    return rows.filter(review_changed("ri", "sq")).select(
        "scorecard_question_id", "scorecard_id", "user_id", "reviewer_id", "project_id",
        ratio_part("answer", 2).alias("num_tests"), ratio_part("answer", 1).alias("num_passed"),
    )


@upsert_load("scorecard_response", 4, ["scorecard_question_id", "scorecard_id"])
def scorecard_response(ctx):
    asked = settle(questions(ctx).filter(F.col("scorecard_question_type_id").isin(*RATED_QUESTIONS)))
    rows = items(ctx, ALL_REVIEWERS, "ri", results=True, asked=asked).filter(F.col("answer") != "").join(asked, "scorecard_question_id")
    rows = rows.filter(review_changed("ri"))
    return rows.withColumn("evaluation_id", evaluation_id("scorecard_question_type_id", "answer"))


@load("subjective_response", 4)
def subjective_response(ctx: LoadContext) -> dict[str, Write]:
    """Comments of changed reviews replace those of their question and scorecard."""
    def found():
        rows = comments(ctx, "ric", 1, 2, 3).join(ctx.source("comment_type_lu").select("comment_type_id"), "comment_type_id", "left_semi")
        item = items(ctx, ALL_REVIEWERS, "ric", "ri", results=True)
        rows = on_items(rows, item, F.col("c_ric"), review_changed("ri")).join(item, "review_item_id")
        return rows.filter(review_changed("ric", "ri"))

    rows = settle_alone(found)
    kind = F.col("comment_type_id")
    rows = rows.withColumns({
        "response_text": F.col("content"),
        "response_type_id": F.when(kind == 1, 3).when(kind == 3, 1).otherwise(2),
        "response_type_desc": F.when(kind == 1, "Comment").when(kind == 3, "Required").otherwise("Recommended"),
    })
    keys = ["scorecard_question_id", "scorecard_id"]
    rows = change_set(ctx.target("subjective_response"), sequences.number_in_group(rows, keys, ["review_item_comment_id"], "sort"))
    target = ctx.around("subjective_response", rows)
    return {"subjective_response": Write(merge.replace_by_key(target, rows, keys), touched=rows.select(*keys))}


@load("submission_review", 4)
def submission_review(ctx: LoadContext) -> dict[str, Write]:
    """Reviews with their appeals, then one response slot per reviewer of a project.

    The slots of a project with a change are given over all its reviewers, those
    that were there before included.
    """
    only = touched_reviews(ctx, "ric")
    found = reviews(ctx, REVIEWERS, only, below=changed_below(ctx, "ric") if only is None and ctx.hwm is not None else None)
    item = settle(joins.Sieve.of(found.select("review_id")).rows(ctx.source("review_item"), "review_id").select("review_item_id", "review_id"))
    appeals = item.join(
        on_items(ctx.source("review_item_comment").filter(F.col("comment_type_id") == APPEAL), item).select(
            "review_item_id", "extra_info", changes.is_changed(ctx.mark(), "modify_date").alias("late")
        ), "review_item_id",
    )
    rows = with_child_values(
        found, appeals, "review_id",
        {
            "num_appeals": F.count(F.lit(1)),
            "num_successful_appeals": tri_state_count(F.col("extra_info").isNotNull(), F.col("extra_info") == "Succeeded"),
            "c_appeal": F.coalesce(F.max("late"), F.lit(False)),
        },
        zero=["num_appeals"],
    )
    rows = rows.filter(F.coalesce("c_appeal", F.lit(False)) | review_changed())
    role = F.col("resource_role_id")
    rows = rows.withColumns({
        "review_resp_id": F.when(role == 7, 1).when(role == 6, 2).when(role == 5, 3).otherwise(4),
        "raw_score": F.col("initial_score"), "final_score": F.col("score"), "scorecard_id": F.col("review_id"),
    })
    rows = change_set(ctx.target("submission_review"), rows)
    projects = settle(rows.select("project_id").distinct())
    # Only the rows of these projects are merged and numbered; they replace the old ones in one step.
    target = ctx.around("submission_review", projects)
    old = target.join(projects, "project_id", "left_semi").select(*target.columns)
    merged = settle(merge.upsert(old, rows, ["project_id", "user_id", "reviewer_id"], ["scorecard_id"], settled=True))
    slots = sequences.assign_slots(
        merged.select("project_id", "reviewer_id", "review_resp_id"), "project_id", "reviewer_id", "review_resp_id"
    )
    new = merge.upsert_columns(merged, slots, ["project_id", "reviewer_id"], ["review_resp_id"])
    return {"submission_review": Write(merge.replace_by_key(target, new, ["project_id"], projects), touched=projects)}


@upsert_load("submission_screening", 4, ["project_id", "user_id"], ["scorecard_id"])
def submission_screening(ctx):
    only = touched_reviews(ctx)
    rows = reviews(ctx, SCREENERS, only, below=changed_below(ctx) if only is None and ctx.hwm is not None else None).filter(review_changed())
    return rows.withColumns({"final_score": F.col("score"), "scorecard_id": F.col("review_id")})


@load("submission", 4)
def submission(ctx: LoadContext) -> dict[str, Write]:
    """Submissions: deleted ones leave, known ones get a new url only. A first run takes all."""
    target = ctx.target("submission")
    resource = flagged(ctx, ctx.source("resource"), "res", F.col("resource_id").alias("upload_resource_id"), inclusive=True)
    submitter = user_of(ctx, "ri", "submitter_id", inclusive=True).withColumnRenamed("ri_resource_id", "upload_resource_id")
    first = changes.is_first_run(target)
    only = None if first else touched_submissions(ctx)
    rows = (
        only_keys(submissions(ctx), only, "submission_id").filter(F.col("upload_type_id") == 1)
        .join(loadable(ctx).select("project_id"), "project_id", "left_semi")
        .join(resource, "upload_resource_id").join(submitter, "upload_resource_id")
    )
    if not first:
        rows = rows.filter("c_s OR c_u OR c_res OR c_ri")
    rows = settle(rows.select("submission_id", "submitter_id", "project_id", "parameter", "submission_status_id"))
    gone = rows.filter(F.col("submission_status_id") == DELETED)
    kept = rows.filter(F.col("submission_status_id") != DELETED).withColumns({
        "submission_url": path_prefix("parameter", ctx.options["submission_dir"]),
        "submission_type": F.lit(1),
    })
    touched = rows.select("submission_id")
    target = merge.delete_keys(ctx.around("submission", touched), gone.select("submission_id"), "submission_id")
    return {"submission": Write(merge.upsert(target, kept, ["submission_id"], update=["submission_url"]), touched=touched)}


