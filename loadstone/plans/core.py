"""What a load is: a function of a context that says how to change which tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.functions import fixed
from loadstone.operators import changes, joins, merge
from loadstone.session import settle, settle_alone


@dataclass
class LoadContext:
    """Tables, mark and options a load works with."""

    source: Callable[[str], DataFrame]
    target: Callable[[str], DataFrame]
    hwm: datetime | None
    as_of: datetime
    options: dict = field(default_factory=dict)
    # Reads the rows of a table that lie near some keys, where the target can tell.
    near: Callable[[str, DataFrame], DataFrame] | None = None

    def around(self, table: str, touched: DataFrame) -> DataFrame:
        """At least all rows of the table whose key is touched; what a merge of these keys has to read."""
        return self.target(table) if self.near is None else self.near(table, touched)

    def first_run(self, table: str) -> bool:
        return changes.is_first_run(self.target(table))

    def mark(self) -> datetime:
        return changes.mark_or_epoch(self.hwm)

    def now(self) -> Column:
        return F.lit(self.as_of).cast("timestamp_ntz")

    def migrating(self) -> bool:
        """True while rows that the migration did not write count as changed."""
        return changes.needs_migrated(self.hwm, self.options.get("migration_cutover", fixed.MIGRATION_CUTOVER))

    def changed(self, *stamps: str, users: Sequence[str] = (), inclusive: Sequence[str] = ()) -> Column:
        """Any stamp after the mark, or a row the migration did not write while that is open."""
        cutover = self.options.get("migration_cutover", fixed.MIGRATION_CUTOVER)
        return changes.is_changed(self.mark(), *stamps, inclusive=inclusive) | changes.not_migrated(
            self.hwm, *users, cutover=cutover
        )


@dataclass
class Write:
    """New state of a table, or rows to append to it.

    ``touched`` holds the keys of all rows that may differ from the old state, where they are known;
    ``rows`` are then the new state of at least these keys, as merged with ``LoadContext.around``.
    """

    rows: DataFrame
    mode: str = "snapshot"
    touched: DataFrame | None = None


@dataclass(frozen=True)
class Load:
    name: str
    stage: int
    run: Callable[[LoadContext], dict[str, Write]]


LOADS: dict[str, Load] = {}


def _register(load: Load) -> Load:
    if load.name in LOADS:
        raise ValueError(f"load {load.name} is declared twice")
    LOADS[load.name] = load
    return load


def load(name: str, stage: int):
    """Declare a load whose function returns the writes itself."""

    def wrap(function: Callable[[LoadContext], dict[str, Write]]) -> Callable:
        _register(Load(name, stage, function))
        return function

    return wrap


def upsert_load(
    table: str, stage: int, keys: Sequence[str], order: Sequence[str] = (), update: Sequence[str] | None = None, checked: bool = False
):
    """Declare a load that updates or inserts the rows its function selects.

    ``checked`` fails the load if a key is not unique in the target.
    """

    def wrap(rows: Callable[[LoadContext], DataFrame]) -> Callable:
        def run(ctx: LoadContext) -> dict[str, Write]:
            changed = change_set(ctx.target(table), rows(ctx))
            target = ctx.around(table, changed)
            if checked:
                target = merge.assert_unique(target, keys)
            return {table: Write(merge.upsert(target, changed, keys, order, update, settled=True), touched=changed.select(*keys))}

        _register(Load(table, stage, run))
        return rows

    return wrap


def replacing(ctx: LoadContext, table: str, rows: DataFrame, keys: Sequence[str], touched: DataFrame) -> Write:
    """Write of a table whose rows of the touched keys are replaced; all keys of ``rows`` have to be among them."""
    return Write(merge.replace_by_key(ctx.around(table, touched), rows, keys, touched), touched=touched)


def change_set(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The columns a target takes from the selected rows, computed once.

    A merge reads its changes for the keys and for the rows; without this it
    would run the joins behind them each time.
    """
    return settle(rows.select(*[c for c in target.columns if c in rows.columns]))


# --- shared row sources ---------------------------------------------------------


def stamped(df: DataFrame, tag: str, *columns: str | Column) -> DataFrame:
    """Columns of a source table plus its change stamp and user under the table's tag."""
    return df.select(*columns, F.col("modify_date").alias(f"m_{tag}"), F.col("modify_user").alias(f"w_{tag}"))


def eligible(ctx: LoadContext, df: DataFrame, key: str = "project_id") -> DataFrame:
    """Without projects that restrict who may take part."""
    restricted = ctx.source("contest_eligibility").filter(F.col("is_studio") == 0)
    return joins.excluding(df, restricted, {key: "contest_id"})


def loadable(ctx: LoadContext) -> DataFrame:
    """Open projects of the loaded categories without restrictions."""
    projects = ctx.source("project").filter(
        (F.col("project_status_id") != fixed.STATUS_DELETED) & F.col("project_category_id").isin(*fixed.LOAD_CATEGORIES)
    )
    return eligible(ctx, projects)


def flagged(ctx: LoadContext, df: DataFrame, tag: str, *columns: str | Column, inclusive: bool = False) -> DataFrame:
    """Columns of a source table plus whether its row changed, under the table's tag.

    One bit per table goes through the joins above, in place of a stamp and a user.
    """
    stamps = {"inclusive": ["modify_date"]} if inclusive else {}
    changed = changes.is_changed(ctx.mark(), *([] if inclusive else ["modify_date"]), **stamps) | changes.not_migrated(
        ctx.hwm, "modify_user", cutover=ctx.options.get("migration_cutover", fixed.MIGRATION_CUTOVER)
    )
    return df.select(*columns, F.coalesce(changed, F.lit(False)).alias(f"c_{tag}"))


def user_of(ctx: LoadContext, tag: str, name: str, attribute: int = 1, inclusive: bool = False) -> DataFrame:
    """(resource of the tag, user id from the resource's attribute) with its flag."""
    info = ctx.source("resource_info").filter(F.col("resource_info_type_id") == attribute)
    return flagged(
        ctx, info, tag, F.col("resource_id").alias(f"{tag}_resource_id"), F.col("value").try_cast("bigint").alias(name), inclusive=inclusive
    )


def submissions(ctx: LoadContext, kind: int = 1, projects: DataFrame | None = None, steps: bool = False) -> DataFrame:
    """Submissions of a type with their upload and flags of both; of the given projects only, where there are any given.

    In ``steps`` the uploads are settled, and other submissions are left out before they are exchanged.
    """
    rows = flagged(
        ctx, ctx.source("submission").filter(F.col("submission_type_id") == kind),
        "s", "submission_id", "upload_id", "submission_status_id",
    )
    uploads = flagged(
        ctx, ctx.source("upload"), "u",
        "upload_id", "project_id", F.col("resource_id").alias("upload_resource_id"), "upload_type_id", "parameter",
    )
    uploads = only_keys(uploads, projects, "project_id")
    if steps:
        uploads = settle(uploads)
        rows = joins.Sieve.of(uploads.select("upload_id")).rows(rows, "upload_id")
    return rows.join(uploads, "upload_id")


def late(ctx: LoadContext, table: str, key: str, where: Column | None = None) -> DataFrame:
    """Keys of a table's rows changed at or after the mark or, while a migration is open, not written by it.

    Plain comparisons of the table's own columns, so they reach its scan.
    """
    changed = F.col("modify_date") >= F.lit(ctx.mark()).cast("timestamp_ntz")
    if ctx.migrating():
        changed = changed | (F.col("modify_user") != fixed.MIGRATION_USER)
    return ctx.source(table).filter(changed if where is None else where & changed).select(key)


def late_users(ctx: LoadContext) -> DataFrame:
    """Ids of resources that changed, or whose user did."""
    users = late(ctx, "resource_info", "resource_id", F.col("resource_info_type_id") == 1)
    return late(ctx, "resource", "resource_id").unionByName(users).distinct()


def touched_submissions(ctx: LoadContext) -> DataFrame:
    """Ids of submissions with a change in themselves, their upload, its resource or that resource's user.

    Each table is read with its own pushed filter and only ids are joined.
    """
    uploads = late(ctx, "upload", "upload_id").unionByName(
        ctx.source("upload").join(late_users(ctx), "resource_id", "left_semi").select("upload_id")
    )
    return late(ctx, "submission", "submission_id").unionByName(
        ctx.source("submission").join(uploads.distinct(), "upload_id", "left_semi").select("submission_id")
    ).distinct()


# Share of late reviews above which looking for the touched ones first costs more than it leaves out.
MANY_LATE = 0.05


def touched_reviews(ctx: LoadContext, *more: str) -> DataFrame | None:
    """Ids of reviews with a change in any table on their way; ``more`` are tags as in ``review_changed``.

    A superset, cheap to find: the rows themselves are filtered once they are joined. None where many reviews
    changed themselves: all are joined then, once, rather than once for the ids and once more for most rows.
    """
    review, item = ctx.source("review"), ctx.source("review_item")
    if late(ctx, "review", "review_id").count() > MANY_LATE * review.count():
        return None
    parts = [
        late(ctx, "review", "review_id"),
        review.join(touched_submissions(ctx), "submission_id", "left_semi").select("review_id"),
        review.join(late_users(ctx), "resource_id", "left_semi").select("review_id"),
    ]
    if "ri" in more:
        parts.append(late(ctx, "review_item", "review_id"))
    if {"ric", "resp"} & set(more):
        items = late(ctx, "review_item_comment", "review_item_id").distinct()
        parts.append(item.join(items, "review_item_id", "left_semi").select("review_id"))
    if "sq" in more:
        asked = late(ctx, "scorecard_question", "scorecard_question_id").distinct()
        parts.append(item.join(asked, "scorecard_question_id", "left_semi").select("review_id"))
    return settle(reduce(DataFrame.unionByName, parts).distinct())


def only_keys(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key is among the ids; all rows without ids."""
    return df if ids is None else df.join(ids, key, "left_semi")


def changed_below(ctx: LoadContext, *more: str) -> joins.Sieve:
    """Sieve of the reviews with a change in their items (tag ri), the comments on these (ric, resp) or their questions (sq).

    For loads that look through all reviews. Ids that lead from table to table pass sieves too, so only ids of changed rows are exchanged.
    """
    item, parts = ctx.source("review_item"), []
    for tags, table, key in (({"ric", "resp"}, "review_item_comment", "review_item_id"), ({"sq"}, "scorecard_question", "scorecard_question_id")):
        if tags & set(more):
            parts.append(joins.Sieve.of(settle(late(ctx, table, key))).rows(item, key).select("review_id"))
    if "ri" in more or not parts:
        parts.append(late(ctx, "review_item", "review_id").filter(F.lit("ri" in more)))
    return joins.Sieve.of(settle(reduce(DataFrame.unionByName, parts)))


def reviews(
    ctx: LoadContext, roles: Sequence[int], only: DataFrame | None = None, results: bool = False,
    below: joins.Sieve | None = None, among: joins.Sieve | None = None,
) -> DataFrame:
    """Reviews by resources of the given roles on submissions of loadable projects,
    with submitter, reviewer and the flags of every table on the way.

    ``only`` names the reviews wanted, ``results`` keeps to projects that have results. The
    submissions, fewer and narrower than the reviews, get all they need before the reviews meet them.
    What cuts the reviews most comes first: the projects with results, else the roles.
    With ``below``, the reviews with a change below them, those without a change below, in or above them are left out
    (but for the few that pass a sieve), before they are exchanged; so are those not ``among`` others.
    Each join is settled: its exchanges go before the next one makes its own.
    """
    return settle_alone(lambda: _reviews(ctx, roles, only, results, below, among))


def _reviews(ctx, roles, only, results, below, among) -> DataFrame:
    review = flagged(
        ctx, only_keys(ctx.source("review"), only, "review_id"), "r", "review_id", "submission_id", F.col("resource_id").alias("review_resource_id"),
        F.col("scorecard_id").alias("scorecard_template_id"), "score", "initial_score",
    )
    resource = flagged(
        ctx, ctx.source("resource").filter(F.col("resource_role_id").isin(*roles)), "res",
        F.col("resource_id").alias("review_resource_id"), "resource_role_id",
    )
    submitter = user_of(ctx, "ri1", "user_id").withColumnRenamed("ri1_resource_id", "upload_resource_id")
    reviewer = user_of(ctx, "ri2", "reviewer_id").withColumnRenamed("ri2_resource_id", "review_resource_id")
    projects = loadable(ctx).select("project_id")
    if results:
        projects = projects.join(ctx.source("project_result").select("project_id"), "project_id", "left_semi")
    handed = settle(submissions(ctx, projects=settle(projects), steps=True))
    submitter = joins.Sieve.of(handed.select("upload_resource_id")).rows(submitter, "upload_resource_id")
    sent = settle(handed.join(submitter, "upload_resource_id").select(
        "submission_id", "project_id", "user_id", (F.col("c_s") | F.col("c_u") | F.col("c_ri1")).alias("c_sent")
    ))
    staff = settle(resource.join(reviewer, "review_resource_id"))
    if among is not None:
        review = among.rows(review, "review_id")
    if below is not None:
        above = {"submission_id": sent.filter("c_sent"), "review_resource_id": staff.filter("c_res OR c_ri2")}
        sieves = [(key, joins.Sieve.of(rows.select(key))) for key, rows in above.items()]
        review = joins.passing(review, F.col("c_r"), [*sieves, ("review_id", below)])
    if results:
        return settle(review.join(sent, "submission_id")).join(staff, "review_resource_id")
    return settle(review.join(staff, "review_resource_id")).join(sent, "submission_id")


REVIEW_TAGS = ("r", "sent", "res", "ri2")


def review_changed(*more: str) -> Column:
    """A change in any table of a review row; ``more`` are tags of further tables."""
    return reduce(Column.__or__, [F.col(f"c_{tag}") for tag in (*more, *REVIEW_TAGS)])
