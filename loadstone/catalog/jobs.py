"""Every load on tables derived from the test tables, next to the same result in SQL."""

from __future__ import annotations

import re
from datetime import datetime
from functools import cache

from pyspark.sql import functions as F

from loadstone.catalog import world
from loadstone.catalog.registry import add
from loadstone.catalog.scalars import _SHARES
from loadstone.functions import fixed
from loadstone.plans import all_loads
from loadstone.plans.core import LoadContext
from loadstone.plans.schemas import SCHEMAS
from loadstone.session import lasting, settle_alone

MARK = datetime(1999, 6, 1)
AS_OF = datetime(2001, 8, 1)
# The migration counts as closed for most loads, so that the mark decides.
CLOSED = {"migration_cutover": "1996-01-01 00:00:00", "submission_dir": "file:/uploads/"}
OPEN = {"submission_dir": "file:/uploads/"}

_RENAMED = {"time.project": "src_billing_project"}


def context(spark, folder: str, hwm, targets: dict[str, str], options: dict, views: dict[str, str] | None = None) -> LoadContext:
    """Sources from the world; targets from it where named, else empty tables.

    ``views`` are the shared tables of a query that builds several contexts.
    """
    views = {} if views is None else views

    def source(name: str):
        return world.spark_table(spark, folder, _RENAMED.get(name, "src_" + name.rpartition(".")[2]), views)

    # A load asks for its target several times, and an older state is the result of a load.
    @cache
    def target(name: str):
        if name in targets:
            state = targets[name]
            with lasting():
                return state(spark, folder, views) if callable(state) else world.spark_table(spark, folder, state, views)
        return spark.createDataFrame([], SCHEMAS[name])

    return LoadContext(source, target, hwm, AS_OF, options)


def _types(table: str) -> dict[str, str]:
    return dict(re.findall(r"(\w+) ((?:decimal\([\d,]+\))|\w+)", SCHEMAS[table]))


def _duck_column(name: str, kind: str) -> str:
    if kind.startswith("decimal"):
        return f"CAST(CAST({name} AS {kind}) AS DOUBLE) AS {name}"
    plain = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "INTEGER"}
    return f"CAST({name} AS {plain[kind]}) AS {name}"


def _spark_column(name: str, kind: str):
    if kind.startswith("decimal"):
        return F.col(name).cast(kind).cast("double").alias(name)
    return F.col(name).cast("int" if kind == "boolean" else kind).alias(name)


JOBS: dict[str, dict] = {}


def job(load: str, columns: str, sql: str, table: str | None = None, hwm=MARK, targets: dict | None = None, options: dict | None = None, name: str | None = None):
    """Register a load; ``columns`` names the SQL's columns in order."""
    table = table or load
    names, types = columns.split(), _types(table)

    def run(spark, folder):
        ctx = context(spark, folder, hwm, targets or {}, CLOSED if options is None else options)
        rows = all_loads()[load].run(ctx)[table].rows
        return rows.select(*[_spark_column(c, types[c]) for c in names])

    run.__name__ = name or f"load_{table}"
    run.__doc__ = f"The {table} table after the load."
    listed = ", ".join(_duck_column(c, types[c]) for c in names)
    add(run.__name__, run, world.duck_sql(f"SELECT {listed} FROM ({sql}) AS result({', '.join(names)})"))
    JOBS[run.__name__] = {"load": load, "names": names, "types": types, "sql": sql, "table": table, "hwm": hwm, "targets": targets or {}, "options": CLOSED if options is None else options}


def on_older_state(name: str, keys: str):
    """Register ``name`` once more, as update_<table>, on a target that holds an older state.

    Every third row by the first key is there without its values, to be updated, and
    once more under a key of its own, to be kept; the others are to be inserted.
    """
    known, key = JOBS[name], keys.split()[0]
    load, table, names, types = (known[k] for k in ("load", "table", "names", "types"))

    def older(spark, folder, views):
        full = context(spark, folder, known["hwm"], known["targets"], known["options"], views)
        rows = settle_alone(lambda: all_loads()[load].run(full)[table].rows.filter(F.col(key) % 3 == 0))
        stale = rows.select(*[F.col(f.name) if f.name in keys.split() else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
        return stale.unionByName(rows.withColumn(key, (-F.col(key) - 1).cast(rows.schema[key].dataType)))

    def run(spark, folder):
        ctx = context(spark, folder, known["hwm"], {**known["targets"], table: older}, known["options"])
        rows = all_loads()[load].run(ctx)[table].rows
        return rows.select(*[_spark_column(c, types[c]) for c in names])

    run.__name__ = name.replace("load_", "update_")
    run.__doc__ = f"The {table} table after the load, from an older state of it."
    listed = ", ".join(_duck_column(c, types[c]) for c in names)
    # The load is worked out once and named twice.
    add(run.__name__, run, world.duck_sql(
        f"WITH result({', '.join(names)}) AS MATERIALIZED ({known['sql']}) "
        f"SELECT {listed} FROM (SELECT * FROM result UNION ALL SELECT {_moved(names, key)} FROM result WHERE {key} % 3 = 0)"
    ))


def _moved(names: list[str], key: str) -> str:
    return ", ".join(f"-{c} - 1 AS {c}" if c == key else c for c in names)


def on_filled_target(name: str, keys: str, touched: str):
    """Register ``name`` once more, as update_<load>, on a target that already holds rows, so that its later run is taken.

    Every third row by the first key is there without its values, and once more under a
    key of its own. Only the keys ``touched`` selects are loaded; the others keep what they have.
    """
    known, key = JOBS[name], keys.split()[0]
    load, table, names, types = (known[k] for k in ("load", "table", "names", "types"))

    def older(spark, folder, views):
        full = context(spark, folder, known["hwm"], known["targets"], known["options"], views)
        rows = settle_alone(lambda: all_loads()[load].run(full)[table].rows.filter(F.col(key) % 3 == 0))
        stale = rows.select(*[F.col(f.name) if f.name in keys.split() else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
        return stale.unionByName(rows.withColumn(key, (-F.col(key) - 1).cast(rows.schema[key].dataType)))

    def run(spark, folder):
        ctx = context(spark, folder, known["hwm"], {**known["targets"], table: older}, known["options"])
        rows = all_loads()[load].run(ctx)[table].rows
        return rows.select(*[_spark_column(c, types[c]) for c in names])

    run.__name__ = f"update_{load}"
    run.__doc__ = f"The {table} table after a later run of the load {load}."
    listed = ", ".join(_duck_column(c, types[c]) for c in names)
    stale = ", ".join(c if c in keys.split() else f"NULL AS {c}" for c in names)
    add(run.__name__, run, world.duck_sql(
        f"WITH result({', '.join(names)}) AS MATERIALIZED ({known['sql']}), changed AS MATERIALIZED ({touched}) "
        f"SELECT {listed} FROM (SELECT * FROM result WHERE {key} IN (SELECT {key} FROM changed) "
        f"UNION ALL SELECT {stale} FROM result WHERE {key} % 3 = 0 AND {key} NOT IN (SELECT {key} FROM changed) "
        f"UNION ALL SELECT {_moved(names, key)} FROM result WHERE {key} % 3 = 0)"
    ))


H = "TIMESTAMP '1999-06-01'"

job("contest", "contest_id contest_name contest_start_timestamp contest_end_timestamp contest_type_id contest_type_desc phase_id event_id project_category_id project_category_name", f"""
SELECT contest_id, contest_name, start_date, end_date, c.contest_type_id, contest_type_desc, phase_id, event_id, c.project_category_id, name
FROM src_contest c JOIN src_contest_type_lu t ON t.contest_type_id = c.contest_type_id
JOIN src_project_category_lu p ON p.project_category_id = c.project_category_id WHERE modify_date > {H}""")

job("contest_prize", "contest_prize_id contest_id prize_type_id prize_type_desc place prize_amount prize_desc", f"""
SELECT contest_prize_id, contest_id, p.prize_type_id, prize_type_desc, place, prize_amount, prize_desc
FROM src_contest_prize p JOIN src_prize_type_lu t ON t.prize_type_id = p.prize_type_id WHERE modify_date > {H}""")

job("track", "track_id track_type_id track_type_desc track_status_id track_status_desc track_desc track_start_date track_end_date", f"""
SELECT track_id, t.track_type_id, track_type_desc, t.track_status_id, track_status_desc, track_desc, track_start_date, track_end_date
FROM src_track t JOIN src_track_type_lu y ON y.track_type_id = t.track_type_id JOIN src_track_status_lu s ON s.track_status_id = t.track_status_id
WHERE create_date > {H}""")

job("track_contest", "track_contest_id track_id track_contest_desc track_contest_type_id track_contest_type_desc", f"""
SELECT track_contest_id, track_id, track_contest_desc, c.track_contest_type_id, track_contest_type_desc
FROM src_track_contest c JOIN src_track_contest_type_lu t ON t.track_contest_type_id = c.track_contest_type_id WHERE create_date > {H}""")

job("coder", "coder_id state_code country_code comp_country_code first_name email address1 address2 city home_phone work_phone image status handle handle_lower "
    "member_since last_login modify_date create_date language_id coder_type_id", """
SELECT c.coder_id, coalesce(a.state_code, ''), CASE WHEN a.country_code IS NULL THEN '' ELSE lpad(trim(a.country_code), 3, '0') END,
       CASE WHEN c.comp_country_code IS NULL THEN '' ELSE lpad(trim(c.comp_country_code), 3, '0') END, u.first_name, e.address,
       coalesce(a.address1, ''), coalesce(a.address2, ''), coalesce(a.city, ''), hp.phone_number, wp.phone_number, coalesce(i.image_id, 0),
       u.status, u.handle, u.handle_lower, c.member_since, u.last_login, u.modify_date, u.create_date, c.language_id, c.coder_type_id
FROM src_coder c JOIN src_user u ON u.user_id = c.coder_id JOIN src_email e ON e.user_id = u.user_id AND e.primary_ind = 1
LEFT JOIN (SELECT x.user_id, a.* FROM src_user_address_xref x JOIN src_address a ON a.address_id = x.address_id AND a.address_type_id = 2) a ON a.user_id = u.user_id
LEFT JOIN src_phone hp ON hp.user_id = u.user_id AND hp.phone_type_id = 2 AND hp.primary_ind = 1
LEFT JOIN src_phone wp ON wp.user_id = u.user_id AND wp.phone_type_id = 1 AND wp.primary_ind = 1
LEFT JOIN (SELECT x.coder_id, m.image_id FROM src_coder_image_xref x JOIN src_image m ON m.image_id = x.image_id WHERE m.image_type_id = 1 AND x.display_flag = 1) i ON i.coder_id = u.user_id
WHERE u.user_id IN (
  SELECT coder_id FROM src_coder WHERE modify_date > TIMESTAMP '2001-06-01'
  UNION SELECT user_id FROM src_user_address_xref x JOIN src_address a ON a.address_id = x.address_id WHERE a.modify_date > TIMESTAMP '2001-06-01'
  UNION SELECT user_id FROM src_phone WHERE modify_date > TIMESTAMP '2001-06-01'
  UNION SELECT coder_id FROM src_coder_image_xref x JOIN src_image m ON m.image_id = x.image_id WHERE m.modify_date > TIMESTAMP '2001-06-01'
  UNION SELECT user_id FROM src_email WHERE modify_date > TIMESTAMP '2001-06-01'
  UNION SELECT user_id FROM src_user WHERE modify_date > TIMESTAMP '2001-06-01')""", hwm=datetime(2001, 6, 1))

job("client_project_dim", "billing_project_id client_project_id client_id client_name client_create_date client_modification_date project_name project_create_date "
    "billing_account_code cmc_account_id customer_number billing_account_status billing_account_start_date billing_account_end_date", """
SELECT b.project_id, b.project_id, a.client_id, a.name, a.creation_date, a.modification_date, b.name, b.creation_date, b.po_box_number,
       a.cmc_account_id, a.customer_number, b.active, b.start_date, b.end_date
FROM src_client a JOIN src_client_project c ON c.client_id = a.client_id JOIN src_billing_project b ON b.project_id = c.project_id
WHERE a.modification_date > TIMESTAMP '2001-06-01' OR b.modification_date > TIMESTAMP '2001-06-01' OR c.modification_date > TIMESTAMP '2001-06-01'""", hwm=datetime(2001, 6, 1))

job("direct_project_dim", "direct_project_id name description project_status_id project_create_date project_modification_date billing_project_id", """
SELECT project_id, name, description, project_status_id, create_date, modify_date,
       coalesce((SELECT max(billing_account_id) FROM src_direct_project_account a WHERE a.project_id = p.project_id), 0)
FROM src_tc_direct_project p WHERE modify_date > TIMESTAMP '1970-01-01'""", hwm=None)

job("evaluation_lu", "evaluation_id evaluation_desc evaluation_value evaluation_type_id evaluation_type_desc", """
SELECT evaluation_id, evaluation_name, value, e.evaluation_type_id, t.eval_type_name
FROM src_evaluation e LEFT JOIN src_evaluation_type t ON t.evaluation_type_id = e.evaluation_type_id""")

job("event", "event_id event_name", f"SELECT event_id, event_desc FROM src_event WHERE modify_date > {H}")

_EVENT_MARK = datetime(2024, 1, 10)
job("event_registration", "event_id user_id eligible_ind notes create_date modify_date", """
SELECT event_id, user_id, eligible_ind, notes, create_date, modify_date FROM src_event_registration WHERE modify_date > TIMESTAMP '2024-01-10'""", hwm=_EVENT_MARK)

job("user_event_xref", "event_id user_id create_date", """
SELECT event_id, user_id, create_date FROM src_user_event_xref WHERE modify_date > TIMESTAMP '2024-01-10'""", hwm=_EVENT_MARK)

_CALENDAR = {"calendar": "dw_calendar"}
job("season", "season_id start_calendar_id end_calendar_id name rookie_competition_ind next_rookie_season_id", f"""
SELECT s.season_id, a.calendar_id, b.calendar_id, s.name, rookie_competition_ind, next_rookie_season_id
FROM src_season s LEFT JOIN (SELECT season_id, min(start_date) AS lo, max(end_date) AS hi FROM src_stage GROUP BY 1) x ON x.season_id = s.season_id
LEFT JOIN dw_calendar a ON a.date = lo LEFT JOIN dw_calendar b ON b.date = hi WHERE modify_date > {H}""", targets=_CALENDAR)

job("stage", "stage_id season_id start_calendar_id end_calendar_id name", f"""
SELECT stage_id, season_id, a.calendar_id, b.calendar_id, name
FROM src_stage LEFT JOIN dw_calendar a ON a.date = start_date LEFT JOIN dw_calendar b ON b.date = end_date WHERE modify_date > {H}""", targets=_CALENDAR)

job("scorecard_template", "scorecard_template_id scorecard_type_id scorecard_type_desc", f"""
SELECT s.scorecard_id, s.scorecard_type_id, t.name FROM src_scorecard s JOIN src_scorecard_type_lu t ON t.scorecard_type_id = s.scorecard_type_id
WHERE s.modify_date > {H} OR t.modify_date > {H} OR s.modify_user <> 'Converter' OR t.modify_user <> 'Converter'""", options=OPEN)

job("scorecard_question", "scorecard_question_id scorecard_template_id question_text question_weight section_id section_desc section_weight section_group_id "
    "section_group_desc question_desc sort question_header", f"""
WITH base AS (
  SELECT q.scorecard_question_id, g.scorecard_id, q.description || q.guideline AS question_text, q.weight, q.scorecard_section_id, s.name AS section_desc,
         s.weight * g.weight / 100 AS section_weight, s.scorecard_group_id, g.name AS group_desc, g.sort + 1 AS a, s.sort + 1 AS b, q.sort + 1 AS c
  FROM src_scorecard_question q JOIN src_scorecard_section s ON s.scorecard_section_id = q.scorecard_section_id
  JOIN src_scorecard_group g ON g.scorecard_group_id = s.scorecard_group_id
  WHERE q.modify_date > {H} OR s.modify_date > {H} OR g.modify_date > {H} OR q.modify_user <> 'Converter'),
cut AS (SELECT *, substr(question_text, 1, 251) AS head FROM base)
SELECT scorecard_question_id, scorecard_id, question_text, weight, scorecard_section_id, section_desc, section_weight, scorecard_group_id, group_desc,
       CAST(a AS VARCHAR) || '.' || CAST(b AS VARCHAR) || '.' || CAST(c AS VARCHAR),
       row_number() OVER (PARTITION BY scorecard_id ORDER BY a, b, c, scorecard_question_id) - 1,
       CASE WHEN strpos(head, chr(10)) > 0 THEN substr(question_text, 1, length(head) - strpos(reverse(head), chr(10)) + 1) || '...'
            WHEN strpos(head, ' ') > 0 THEN substr(question_text, 1, length(head) - strpos(reverse(head), ' ')) || '...' ELSE question_text END
FROM cut""", options=OPEN)

job("user_contest_prize", "user_id contest_id prize_type_id place prize_description prize_amount prize_payment", f"""
WITH r AS (SELECT u.user_id, p.contest_id, p.prize_type_id, p.place, p.prize_desc, p.prize_amount, u.payment
  FROM src_user_contest_prize u JOIN src_contest_prize p ON p.contest_prize_id = u.contest_prize_id JOIN src_prize_type_lu t ON t.prize_type_id = p.prize_type_id
  WHERE p.modify_date > {H})
SELECT * FROM r""")

job("royalty", "user_id amount royalty_date description", f"SELECT user_id, amount, royalty_date, description FROM src_royalty WHERE modify_date > {H}")

job("user_reliability", "user_id rating phase_id", f"SELECT user_id, rating, phase_id FROM src_user_reliability WHERE modify_date > {H}")

job("projects", "id directProjectId billingAccountId name external utm estimatedPrice actualPrice type status deletedAt createdAt createdBy updatedBy", """
SELECT id, directProjectId, billingAccountId, name, external, utm, estimatedPrice, coalesce(actualPrice, 0), type, status, deletedAt, createdAt, createdBy, updatedBy FROM src_projects""")

job("project_members", "id role userId isPrimary deletedAt createdAt updatedAt createdBy updatedBy", """
SELECT id, role, userId, isPrimary, deletedAt, createdAt, updatedAt, createdBy, updatedBy FROM src_project_members""")

ELIGIBLE = "p.project_id NOT IN (SELECT contest_id FROM src_contest_eligibility WHERE is_studio = 0)"

job("contest_project_xref", "contest_id project_id", f"""
SELECT x.contest_id, x.project_id FROM src_contest_project_xref x JOIN src_project p ON p.project_id = x.project_id
WHERE {ELIGIBLE} AND (p.modify_date > {H} OR x.create_date > {H}) AND x.project_id IN (SELECT project_id FROM src_project_result)""")

job("project_spec_review_xref", "project_id spec_review_project_id", """
SELECT b.project_id, s.project_id FROM src_project b JOIN src_linked_project_xref x ON x.source_project_id = b.project_id AND x.link_type_id = 3
JOIN src_project s ON s.project_id = x.dest_project_id AND s.project_category_id = 27 WHERE b.project_id IN (SELECT project_id FROM dw_project)""", targets={"project": "dw_project"})

# --- projects -------------------------------------------------------------------

_CATEGORIES = "(" + ", ".join(map(str, fixed.LOAD_CATEGORIES)) + ")"
_PROJECT_TARGETS = {"calendar": "dw_calendar", "stage": "dw_stage"}


def _info(number: int) -> str:
    return f"(SELECT v{number} FROM src_attributes i WHERE i.project_id = p.project_id)"


def _phase(number: int, column: str, extra: str = "") -> str:
    return f"(SELECT {column} FROM src_project_phase h WHERE h.project_id = p.project_id AND h.phase_type_id = {number}{extra})"


_SENT_STATES = {(1, "<> 5"): "all1", (1, "IN (1, 3, 4)"): "valid1", (1, "IN (1, 4)"): "passed1", (3, "<> 5"): "all3", (3, "IN (1, 3, 4, 7)"): "valid3"}


def _submitted(kind: int, states: str) -> str:
    return f"coalesce((SELECT k.{_SENT_STATES[kind, states]} FROM sent_counts k WHERE k.project_id = p.project_id), 0)"


def _sent_steps() -> str:
    counts = ", ".join(
        f"count(*) FILTER (s.submission_type_id = {kind} AND s.submission_status_id {states}) AS {name}" for (kind, states), name in _SENT_STATES.items()
    )
    return f"sent_counts AS MATERIALIZED (SELECT u.project_id, {counts} FROM src_submission s JOIN src_upload u ON u.upload_id = s.upload_id GROUP BY 1)"


_COST_TYPES = {None: "paid", (24,): "reliability", (7, 26, 28, 36): "review", fixed.PRIZE_PAYMENTS: "prize", (45, 57): "copilot"}


def _cost(types: tuple[int, ...] | None) -> str:
    return f"coalesce((SELECT k.{_COST_TYPES[types]} FROM costs k WHERE k.project_id = p.project_id), 0)"


def _cost_steps() -> str:
    counted = "{a}.installment_number = 1 AND {a}.payment_status_id NOT IN (65, 68, 69)"
    sums = ", ".join(
        f"sum(total_amount){'' if types is None else ' FILTER (payment_type_id IN (' + ', '.join(map(str, types)) + '))'} AS {name}"
        for types, name in _COST_TYPES.items()
    )
    return f"""
spent AS MATERIALIZED (
  SELECT l.component_project_id AS project_id, l.payment_type_id, l.total_amount FROM latest l WHERE {counted.format(a='l')}
  UNION ALL
  SELECT l.component_project_id, c.payment_type_id, c.total_amount FROM latest c JOIN latest l ON l.payment_id = c.parent_payment_id WHERE {counted.format(a='c')}),
costs AS MATERIALIZED (SELECT project_id, {sums} FROM spent WHERE project_id IS NOT NULL GROUP BY 1)"""


def _money(text: str) -> str:
    return f"coalesce(TRY_CAST({text} AS DECIMAL(18,2)), 0)"


_TOUCHED = f"""
touched AS (
  SELECT project_id FROM src_project WHERE modify_date > {H}
  UNION SELECT i.project_id FROM src_project_info i JOIN src_comp_versions v ON CAST(v.comp_vers_id AS VARCHAR) = i.value WHERE i.project_info_type_id = 1 AND v.modify_date > {H}
  UNION SELECT project_id FROM src_resource WHERE create_date > {H} OR modify_date > {H}
  UNION SELECT u.project_id FROM src_upload u JOIN src_submission s ON s.upload_id = u.upload_id WHERE s.submission_type_id = 1
        AND (u.create_date > {H} OR u.modify_date > {H} OR s.create_date > {H} OR s.modify_date > {H})
  UNION SELECT project_id FROM src_project_result WHERE create_date > {H} OR modify_date > {H}
  UNION SELECT project_id FROM src_project_info WHERE project_info_type_id IN (2, 3, 21, 22, 23, 26, 31, 32, 33, 38, 45, 49) AND (create_date > {H} OR modify_date > {H})
  UNION SELECT d.component_project_id FROM src_payment m JOIN src_payment_detail d ON d.payment_detail_id = m.most_recent_detail_id
        WHERE d.payment_status_id NOT IN (65, 69) AND (d.create_date > {H} OR d.date_modified > {H} OR m.create_date > {H} OR m.modify_date > {H}))"""

_LATEST = """
latest AS MATERIALIZED (SELECT m.payment_id, d.* FROM src_payment m JOIN src_payment_detail d ON d.payment_detail_id = m.most_recent_detail_id)"""

job("project",
    "project_id component_id component_name num_registrations num_submissions num_valid_submissions num_submissions_passed_review "
    "num_checkpoint_submissions num_valid_checkpoint_submissions first_place_prize total_prize checkpoint_prize_number checkpoint_prize_amount "
    "avg_raw_score avg_final_score phase_id phase_desc category_id category_desc viewable_category_ind posting_date submitby_date complete_date rating_date "
    "review_phase_id review_phase_name status_id status_desc version_id version_text suspended_ind winner_id digital_run_ind project_category_id "
    "tc_direct_project_id admin_fee contest_prizes_total client_project_id duration challenge_manager challenge_creator challenge_launcher copilot "
    "checkpoint_start_date checkpoint_end_date registration_end_date scheduled_end_date dr_points reliability_cost review_cost actual_total_prize copilot_cost "
    "forum_id submission_viewable is_private estimated_reliability_cost estimated_review_cost estimated_copilot_cost estimated_admin_fee task_ind "
    "stage_id fulfillment start_date_calendar_id", f"""
WITH {_TOUCHED}, {_LATEST}, {_cost_steps()}, {_sent_steps()},
spans AS (SELECT s.stage_id, a.date AS lo, b.date AS hi FROM dw_stage s JOIN dw_calendar a ON a.calendar_id = s.start_calendar_id JOIN dw_calendar b ON b.calendar_id = s.end_calendar_id),
firsts AS (SELECT r.project_id, min(r.resource_id) FILTER (r.resource_role_id = 13) AS m, min(r.resource_id) FILTER (r.resource_role_id = 14) AS c FROM src_resource r GROUP BY 1),
live AS (SELECT project_id, min(project_phase_id) AS phase FROM src_project_phase WHERE phase_status_id = 2 GROUP BY 1),
base AS (
  SELECT p.*, cc.component_id, cc.component_name, cat.category_id, cat.category_name, cat.viewable, psl.name AS stat_name, pcl.name AS cat_name, pcl.project_type_id,
         v.version, v.version_text, v.suspended_ind,
         coalesce({_phase(1, 'actual_start_time')}, {_phase(1, 'scheduled_start_time')}) AS posted,
         {_info(26)} AS run, {_info(30)} AS run_points, {_cost(None)} AS paid, {_info(57)} AS pct, {_info(31)} AS fee
  FROM src_project p JOIN src_comp_versions v ON CAST(v.comp_vers_id AS VARCHAR) = {_info(1)}
  JOIN src_comp_catalog cc ON CAST(cc.component_id AS VARCHAR) = {_info(2)}
  JOIN src_categories cat ON cat.category_id = cc.root_category_id JOIN src_project_status_lu psl ON psl.project_status_id = p.project_status_id
  JOIN src_project_category_lu pcl ON pcl.project_category_id = p.project_category_id
  WHERE {ELIGIBLE} AND p.project_category_id IN {_CATEGORIES} AND p.project_id IN (SELECT project_id FROM touched) AND p.project_status_id <> 3 AND v.version <= 999),
more AS (
  SELECT p.*, paid + CASE WHEN project_status_id = 7 AND run = 'On' THEN {_money('run_points')} ELSE 0 END AS prizes,
         CASE WHEN project_type_id <> 3 AND project_category_id NOT IN (9, 29, 39)
              THEN (SELECT max(h.actual_end_time) FROM src_project_phase h WHERE h.project_id = p.project_id AND h.phase_type_id = 10 AND h.phase_status_id = 3
                    AND h.actual_end_time <= (SELECT min(coalesce(k.actual_start_time, k.scheduled_start_time)) FROM src_project_phase k WHERE k.project_id = p.project_id AND k.phase_type_id = 11))
              ELSE {_phase(4, 'actual_end_time', ' AND h.phase_status_id = 3')} END AS ended,
         TRY_CAST({_info(21)} AS TIMESTAMP) AS completed
  FROM base p)
SELECT p.project_id, component_id, component_name, (SELECT count(*) FROM src_resource r WHERE r.project_id = p.project_id AND r.resource_role_id = 1),
  {_submitted(1, '<> 5')}, {_submitted(1, 'IN (1, 3, 4)')}, {_submitted(1, 'IN (1, 4)')}, {_submitted(3, '<> 5')}, {_submitted(3, 'IN (1, 3, 4, 7)')},
  coalesce((SELECT sum(prize_amount) FROM src_prize z WHERE z.project_id = p.project_id AND prize_type_id = 15 AND place = 1), 0),
  coalesce((SELECT sum(number_of_submissions * prize_amount) FROM src_prize z WHERE z.project_id = p.project_id AND prize_type_id IN (14, 15)), 0),
  coalesce((SELECT sum(number_of_submissions) FROM src_prize z WHERE z.project_id = p.project_id AND prize_type_id = 14), 0),
  coalesce((SELECT max(prize_amount) FROM src_prize z WHERE z.project_id = p.project_id AND prize_type_id = 14), 0),
  (SELECT avg(raw_score) FROM src_project_result r WHERE r.project_id = p.project_id), (SELECT avg(final_score) FROM src_project_result r WHERE r.project_id = p.project_id),
  project_category_id + 111, cat_name, category_id, category_name, viewable, CAST(posted AS DATE), {_phase(2, 'actual_end_time')}, completed, TRY_CAST({_info(22)} AS TIMESTAMP),
  coalesce(lp.phase_type_id, 0), lt.name, project_status_id, stat_name, version, version_text, suspended_ind, CAST({_info(23)} AS BIGINT),
  CASE WHEN run IN ('On', 'Yes') THEN 1 ELSE 0 END, project_category_id, tc_direct_project_id,
  CASE WHEN {_money('pct')} < 0.00001 THEN CASE WHEN project_status_id IN (4, 5, 6, 8, 11) THEN 0 ELSE {_money('fee')} END ELSE {_money('pct')} * prizes END, prizes,
  CASE WHEN CAST({_info(32)} AS BIGINT) > 0 THEN CAST({_info(32)} AS BIGINT) END,
  CASE WHEN ended >= posted THEN date_diff('second', posted, ended) // 60 END,
  (SELECT u.user_id FROM src_resource_info ri JOIN src_user u ON CAST(u.user_id AS VARCHAR) = ri.value WHERE ri.resource_id = f.m AND ri.resource_info_type_id = 1),
  (SELECT u.user_id FROM src_user u WHERE u.user_id = p.create_user), (SELECT u.user_id FROM src_user u WHERE CAST(u.user_id AS VARCHAR) = {_info(58)}),
  (SELECT u.user_id FROM src_resource r JOIN src_user u ON u.user_id = r.user_id WHERE r.resource_id = f.c),
  coalesce({_phase(15, 'actual_start_time')}, {_phase(15, 'scheduled_start_time')}), coalesce({_phase(17, 'actual_end_time')}, {_phase(17, 'scheduled_end_time')}),
  coalesce({_phase(1, 'actual_end_time')}, {_phase(1, 'scheduled_end_time')}), (SELECT max(scheduled_end_time) FROM src_project_phase h WHERE h.project_id = p.project_id),
  CASE WHEN run = 'On' THEN {_money('run_points')} ELSE 0 END,
  {_cost((24,))}, {_cost((7, 26, 28, 36))}, {_cost(fixed.PRIZE_PAYMENTS)}, {_cost((45, 57))},
  CAST({_info(4)} AS BIGINT), CASE {_info(53)} WHEN 'true' THEN 1 WHEN 'false' THEN 0 END,
  CASE WHEN EXISTS (SELECT 1 FROM src_contest_eligibility e WHERE e.contest_id = p.project_id) THEN 1 ELSE 0 END,
  CASE WHEN {_info(45)} = 'true' THEN {_money(_info(38))} ELSE 0 END, {_money(_info(33))} + {_money(_info(35))}, {_money(_info(49))}, {_money('fee')},
  coalesce(CAST({_info(82)} AS BIGINT), 0),
  (SELECT min(stage_id) FROM spans WHERE CAST(posted AS DATE) BETWEEN CAST(lo AS DATE) AND CAST(hi AS DATE)),
  CASE WHEN completed IS NOT NULL AND tc_direct_project_id > 0 AND posted IS NOT NULL THEN CASE WHEN project_status_id = 7 THEN 1 ELSE 0 END END,
  CASE WHEN completed IS NOT NULL AND tc_direct_project_id > 0 THEN (SELECT calendar_id FROM dw_calendar k WHERE CAST(k.date AS DATE) = CAST(posted AS DATE)) END
FROM more p LEFT JOIN firsts f ON f.project_id = p.project_id LEFT JOIN live l ON l.project_id = p.project_id
LEFT JOIN src_project_phase lp ON lp.project_phase_id = l.phase LEFT JOIN src_phase_type_lu lt ON lt.phase_type_id = lp.phase_type_id""",
    targets=_PROJECT_TARGETS)


job("marathon_match",
    "project_id component_id component_name num_registrations num_submissions phase_id category_id posting_date submitby_date complete_date status_id version_id "
    "project_category_id tc_direct_project_id admin_fee contest_prizes_total client_project_id duration first_place_prize total_prize fulfillment start_date_calendar_id", f"""
WITH {_LATEST},
base AS (
  SELECT p.*, cc.component_id, cc.component_name, cc.root_category_id, v.version, CAST({_info(56)} AS BIGINT) AS round_id, {_info(57)} AS pct, {_info(31)} AS fee,
         TRY_CAST({_info(21)} AS TIMESTAMP) AS completed
  FROM src_project p JOIN src_comp_versions v ON CAST(v.comp_vers_id AS VARCHAR) = {_info(1)} JOIN src_comp_catalog cc ON CAST(cc.component_id AS VARCHAR) = {_info(2)}
  WHERE {ELIGIBLE} AND p.project_category_id = 37 AND p.project_status_id = 7 AND v.version <= 999 AND {_info(56)} IS NOT NULL),
more AS (
  SELECT p.*, (SELECT start_time FROM src_round_segment g WHERE g.round_id = p.round_id AND segment_id = 1) AS posted,
         (SELECT end_time FROM src_round_segment g WHERE g.round_id = p.round_id AND segment_id = 4) AS ended,
         coalesce((SELECT sum(total_amount) FROM latest l WHERE l.algorithm_round_id = p.round_id AND installment_number = 1 AND component_project_id IS NULL AND payment_status_id NOT IN (65, 68, 69)), 0) AS prizes
  FROM base p)
SELECT project_id, component_id, component_name, (SELECT count(*) FROM src_round_registration r WHERE r.round_id = p.round_id),
  (SELECT count(*) FROM src_long_component_state c JOIN src_long_submission s ON s.long_component_state_id = c.long_component_state_id WHERE c.round_id = p.round_id AND s.example = 0),
  148, root_category_id, CAST(posted AS DATE), (SELECT end_time FROM src_round_segment g WHERE g.round_id = p.round_id AND segment_id = 2), completed, project_status_id, version,
  project_category_id, tc_direct_project_id, CASE WHEN {_money('pct')} < 0.00001 THEN {_money('fee')} ELSE {_money('pct')} * prizes END, prizes,
  CASE WHEN CAST({_info(32)} AS BIGINT) > 0 THEN CAST({_info(32)} AS BIGINT) END, CASE WHEN ended >= posted THEN date_diff('second', posted, ended) // 60 END,
  coalesce((SELECT sum(prize_amount) FROM src_prize z WHERE z.project_id = p.project_id AND prize_type_id = 15 AND place = 1), 0),
  coalesce((SELECT sum(number_of_submissions * prize_amount) FROM src_prize z WHERE z.project_id = p.project_id AND prize_type_id IN (14, 15)), 0),
  CASE WHEN completed IS NOT NULL AND tc_direct_project_id > 0 AND posted IS NOT NULL THEN 1 END,
  CASE WHEN completed IS NOT NULL AND tc_direct_project_id > 0 THEN (SELECT calendar_id FROM dw_calendar k WHERE CAST(k.date AS DATE) = CAST(posted AS DATE)) END
FROM more p""", table="project", targets=_PROJECT_TARGETS, name="load_marathon_match")

job("project_platform", "project_id project_platform_id name", """
SELECT x.project_id, x.project_platform_id, l.name FROM src_project_platform x JOIN src_project_platform_lu l ON l.project_platform_id = x.project_platform_id
JOIN src_project p ON p.project_id = x.project_id""")

job("project_technology", "project_id project_technology_id name", """
SELECT p.project_id, t.technology_type_id, y.technology_name FROM src_project p JOIN src_project_info i ON i.project_id = p.project_id AND i.project_info_type_id = 1
JOIN src_comp_technology t ON CAST(t.comp_vers_id AS VARCHAR) = i.value JOIN src_technology_types y ON y.technology_type_id = t.technology_type_id""")

# --- reviews --------------------------------------------------------------------


def _review_steps(roles: str) -> str:
    """Reviews on open projects, one small join at a time, with the last change on the way and whether a row is not of the migration."""
    return f"""WITH open_project AS MATERIALIZED (
  SELECT p.project_id FROM src_project p WHERE p.project_status_id <> 3 AND p.project_category_id IN {_CATEGORIES} AND {ELIGIBLE}),
named AS MATERIALIZED (SELECT resource_id, value, modify_date AS m, modify_user <> 'Converter' AS o FROM src_resource_info WHERE resource_info_type_id = 1),
uploaded AS MATERIALIZED (
  SELECT u.upload_id, u.project_id, n.value AS user_id, greatest(u.modify_date, n.m) AS m, n.o OR u.modify_user <> 'Converter' AS o
  FROM src_upload u JOIN open_project p ON p.project_id = u.project_id JOIN named n ON n.resource_id = u.resource_id),
entered AS MATERIALIZED (
  SELECT s.submission_id, u.project_id, u.user_id, greatest(s.modify_date, u.m) AS m, u.o OR s.modify_user <> 'Converter' AS o
  FROM src_submission s JOIN uploaded u ON u.upload_id = s.upload_id WHERE s.submission_type_id = 1),
reviewer AS MATERIALIZED (
  SELECT r.resource_id, r.resource_role_id AS role, n.value AS reviewer_id, greatest(r.modify_date, n.m) AS m, n.o OR r.modify_user <> 'Converter' AS o
  FROM src_resource r JOIN named n ON n.resource_id = r.resource_id WHERE r.resource_role_id IN {roles}),
reviewed AS MATERIALIZED (
  SELECT r.review_id, r.scorecard_id, r.score, r.initial_score, e.project_id, e.user_id, w.reviewer_id, w.role, greatest(r.modify_date, e.m, w.m) AS modify_date,
    r.modify_user <> 'Converter' OR e.o OR w.o AS own
  FROM src_review r JOIN entered e ON e.submission_id = r.submission_id JOIN reviewer w ON w.resource_id = r.resource_id)"""


def _item_steps(roles: str) -> str:
    return _review_steps(roles) + """,
item AS MATERIALIZED (
  SELECT i.review_item_id, i.scorecard_question_id, i.answer, r.review_id, r.project_id, r.user_id, r.reviewer_id, greatest(i.modify_date, r.modify_date) AS modify_date
  FROM src_review_item i JOIN reviewed r ON r.review_id = i.review_id)"""


def _after(*aliases: str, mark: str = H) -> str:
    return "(" + " OR ".join(f"{a}.modify_date > {mark}" for a in aliases) + ")"


_LATE = "TIMESTAMP '2001-03-01'"
_LATE_MARK = datetime(2001, 3, 1)


def _evaluation(kind: str, answer: str) -> str:
    scale = lambda top: f"regexp_full_match({answer}, '({top})')"
    four = f"CASE WHEN {scale('[1-4](/4)?')} THEN CAST(substr({answer}, 1, 1) AS INTEGER) END"
    ten = f"CASE WHEN {scale('(10|[1-9])(/10)?')} THEN 10 + CAST(split_part({answer}, '/', 1) AS INTEGER) END"
    return (
        f"nullif(CASE WHEN {answer} IS NULL OR trim({answer}) = '' THEN NULL WHEN {kind} = 1 THEN coalesce({four}, {ten}) WHEN {kind} = 2 THEN {ten} "
        f"WHEN {kind} = 3 THEN NULL WHEN {kind} = 4 THEN CASE WHEN {answer} IN ('Yes', '1') THEN 5 ELSE 6 END ELSE TRY_CAST({answer} AS INTEGER) END, 0)"
    )


_SUCCESS = "CASE WHEN ric.extra_info IS NULL THEN NULL WHEN ric.extra_info = 'Succeeded' THEN 1 ELSE 0 END"

job("appeal", "appeal_id scorecard_question_id scorecard_id project_id user_id reviewer_id raw_evaluation_id final_evaluation_id appeal_text appeal_response successful_ind", f"""
{_item_steps('(4, 5, 6, 7)')}
SELECT ric.review_item_comment_id, ri.scorecard_question_id, ri.review_id, ri.project_id, ri.user_id, ri.reviewer_id,
       {_evaluation('sq.scorecard_question_type_id', 'resp.extra_info')}, {_evaluation('sq.scorecard_question_type_id', 'ri.answer')},
       coalesce(ric.content, ''), coalesce(resp.content, ''), {_SUCCESS}
FROM item ri
JOIN src_review_item_comment ric ON ric.review_item_id = ri.review_item_id AND ric.comment_type_id = 4
JOIN src_scorecard_question sq ON sq.scorecard_question_id = ri.scorecard_question_id
LEFT JOIN src_review_item_comment resp ON resp.review_item_id = ri.review_item_id AND resp.comment_type_id = 5
WHERE {_after('ric', 'ri', mark=_LATE)}""", hwm=_LATE_MARK)


def _part(answer: str, n: int, checked: bool) -> str:
    number = f"TRY_CAST(split_part({answer}, '/', {n}) AS INTEGER)"
    usable = f"strpos({answer}, '/') > 0"
    if checked:
        usable += f" AND TRY_CAST(split_part({answer}, '/', 1) AS INTEGER) IS NOT NULL AND TRY_CAST(split_part({answer}, '/', 2) AS INTEGER) IS NOT NULL"
    return f"CASE WHEN {usable} THEN {number} ELSE 1 END"


job("testcase_appeal", "appeal_id scorecard_question_id scorecard_id project_id user_id reviewer_id raw_num_passed raw_num_tests final_num_passed final_num_tests appeal_text appeal_response successful_ind", f"""
{_item_steps('(4, 5, 6, 7)')}
SELECT ric.review_item_comment_id, ri.scorecard_question_id, ri.review_id, ri.project_id, ri.user_id, ri.reviewer_id,
       {_part('resp.extra_info', 1, False)}, {_part('resp.extra_info', 2, False)}, {_part('ri.answer', 1, False)}, {_part('ri.answer', 2, False)},
       ric.content, resp.content, {_SUCCESS}
FROM item ri
JOIN src_review_item_comment ric ON ric.review_item_id = ri.review_item_id AND ric.comment_type_id = 4
JOIN src_review_item_comment resp ON resp.review_item_id = ri.review_item_id AND resp.comment_type_id = 5
JOIN src_scorecard_question sq ON sq.scorecard_question_id = ri.scorecard_question_id AND sq.scorecard_question_type_id = 3
WHERE ri.project_id IN (SELECT project_id FROM src_project_result) AND {_after('ric', 'ri', 'sq', 'resp')}""")

job("testcase_response", "scorecard_question_id scorecard_id project_id user_id reviewer_id num_tests num_passed", f"""
{_item_steps('(4, 5, 6, 7)')}
SELECT ri.scorecard_question_id, ri.review_id, ri.project_id, ri.user_id, ri.reviewer_id, {_part('ri.answer', 2, True)}, {_part('ri.answer', 1, True)}
FROM item ri
JOIN src_scorecard_question sq ON sq.scorecard_question_id = ri.scorecard_question_id AND sq.scorecard_question_type_id = 3
WHERE {_after('ri', 'sq')}""")

job("scorecard_response", "scorecard_question_id scorecard_id project_id user_id reviewer_id evaluation_id", f"""
{_item_steps('(2, 3, 4, 5, 6, 7)')}
SELECT ri.scorecard_question_id, ri.review_id, ri.project_id, ri.user_id, ri.reviewer_id, {_evaluation('sq.scorecard_question_type_id', 'ri.answer')}
FROM item ri
JOIN src_scorecard_question sq ON sq.scorecard_question_id = ri.scorecard_question_id AND sq.scorecard_question_type_id IN (1, 2, 4)
WHERE ri.answer <> '' AND ri.project_id IN (SELECT project_id FROM src_project_result) AND {_after('ri', mark=_LATE)}""", hwm=_LATE_MARK)

job("subjective_response", "scorecard_question_id scorecard_id project_id user_id reviewer_id response_text response_type_id response_type_desc sort", f"""
{_item_steps('(2, 3, 4, 5, 6, 7)')}
SELECT ri.scorecard_question_id, ri.review_id, ri.project_id, ri.user_id, ri.reviewer_id, ric.content,
       CASE ric.comment_type_id WHEN 1 THEN 3 WHEN 3 THEN 1 ELSE 2 END, CASE ric.comment_type_id WHEN 1 THEN 'Comment' WHEN 3 THEN 'Required' ELSE 'Recommended' END,
       row_number() OVER (PARTITION BY ri.scorecard_question_id, ri.review_id ORDER BY ric.review_item_comment_id) - 1
FROM item ri
JOIN src_review_item_comment ric ON ric.review_item_id = ri.review_item_id AND ric.comment_type_id IN (1, 2, 3)
WHERE ri.project_id IN (SELECT project_id FROM src_project_result) AND {_after('ric', 'ri', mark=_LATE)}""", hwm=_LATE_MARK)

job("submission_review", "project_id user_id reviewer_id num_appeals num_successful_appeals final_score raw_score review_resp_id scorecard_id scorecard_template_id", f"""
{_review_steps('(4, 5, 6, 7)')},
ap AS MATERIALIZED (
  SELECT ri.review_id, count(*) AS n, count(CASE WHEN extra_info = 'Succeeded' THEN 1 END) AS ok, count(extra_info) AS known, max(c.modify_date) AS m
  FROM src_review_item ri JOIN src_review_item_comment c ON c.review_item_id = ri.review_item_id AND c.comment_type_id = 4 GROUP BY 1),
rows AS (
  SELECT r.project_id, CAST(r.user_id AS BIGINT) AS user_id, CAST(r.reviewer_id AS BIGINT) AS reviewer_id, coalesce(n, 0) AS n, CASE WHEN known > 0 THEN ok END AS ok, r.score, r.initial_score,
         CASE r.role WHEN 7 THEN 1 WHEN 6 THEN 2 WHEN 5 THEN 3 ELSE 4 END AS resp, r.review_id, r.scorecard_id
  FROM reviewed r LEFT JOIN ap ON ap.review_id = r.review_id WHERE {_after('r')} OR ap.m > {H}),
members AS (SELECT project_id, reviewer_id, min(resp) AS resp FROM rows GROUP BY 1, 2),
slots AS (SELECT project_id, reviewer_id, CASE WHEN resp < 4 THEN resp ELSE 3 + row_number() OVER (PARTITION BY project_id, resp < 4 ORDER BY reviewer_id) END AS slot FROM members)
SELECT r.project_id, user_id, r.reviewer_id, n, ok, score, initial_score, slot, review_id, scorecard_id FROM rows r
JOIN slots s ON s.project_id = r.project_id AND s.reviewer_id = r.reviewer_id""")

job("submission_screening", "project_id user_id reviewer_id final_score scorecard_id scorecard_template_id", f"""
{_review_steps('(2, 3)')}
SELECT project_id, user_id, reviewer_id, score, review_id, scorecard_id FROM reviewed r WHERE {_after('r')}""")

# While a migration is open, rows that it did not write count as changed, whatever their date.
job("submission_screening", "project_id user_id reviewer_id final_score scorecard_id scorecard_template_id", f"""
{_review_steps('(2, 3)')}
SELECT project_id, user_id, reviewer_id, score, review_id, scorecard_id FROM reviewed r WHERE {_after('r', mark="TIMESTAMP '2003-01-01'")} OR own""",
    hwm=datetime(2003, 1, 1), options=OPEN, name="load_submission_screening_migrating")

_SUBMITTED = f"""
SELECT s.submission_id, ri.value AS submitter_id, u.project_id, CASE WHEN strpos(u.parameter, '/') <= 1 THEN 'file:/uploads/' || u.parameter ELSE u.parameter END AS url,
       s.submission_status_id AS st, (s.modify_date > {H} OR u.modify_date > {H} OR r.modify_date >= {H} OR ri.modify_date >= {H}) AS fresh
FROM src_submission s JOIN src_upload u ON u.upload_id = s.upload_id AND s.submission_type_id = 1 AND u.upload_type_id = 1
JOIN src_project p ON p.project_id = u.project_id AND p.project_status_id <> 3 AND p.project_category_id IN {_CATEGORIES} AND {ELIGIBLE}
JOIN src_resource r ON r.resource_id = u.resource_id JOIN src_resource_info ri ON ri.resource_id = r.resource_id AND ri.resource_info_type_id = 1"""

job("submission", "submission_id submitter_id project_id submission_url submission_type", f"""
SELECT submission_id, submitter_id, project_id, url, 1 FROM ({_SUBMITTED}) x WHERE st <> 5""", name="load_submission_first")

job("submission", "submission_id submitter_id project_id submission_url submission_type", f"""
WITH x AS ({_SUBMITTED}), old AS (SELECT * FROM dw_submission), ch AS (SELECT * FROM x WHERE fresh)
SELECT o.submission_id, CAST(o.submitter_id AS BIGINT), o.project_id, coalesce(c.url, o.submission_url), 1 FROM old o LEFT JOIN ch c ON c.submission_id = o.submission_id
WHERE c.st IS NULL OR c.st <> 5
UNION ALL
SELECT submission_id, CAST(submitter_id AS BIGINT), project_id, url, 1 FROM ch WHERE st <> 5 AND submission_id NOT IN (SELECT submission_id FROM old)""", targets={"submission": "dw_submission"})

# --- results --------------------------------------------------------------------


def _with_component(results: bool, projects: str, changed: bool = True) -> str:
    stamps = ["p.modify_date", "v.modify_date", "i.modify_date", "cc.modify_date"] + (["pr.modify_date"] if results else [])
    return f"""
SELECT DISTINCT p.project_id FROM {projects}
JOIN src_project_info i ON i.project_id = p.project_id AND i.project_info_type_id = 1
JOIN src_comp_versions v ON CAST(v.comp_vers_id AS VARCHAR) = i.value JOIN src_comp_catalog cc ON cc.component_id = v.component_id
{'JOIN src_project_result pr ON pr.project_id = p.project_id' if results else ''}
WHERE {ELIGIBLE} {'AND (' + ' OR '.join(f'{s} > {H}' for s in stamps) + ')' if changed else ''}"""


_LOADED = f"(SELECT * FROM src_project WHERE project_status_id <> 3 AND project_category_id IN {_CATEGORIES}) p"
_SENT = """
sent AS (SELECT u.project_id, u.resource_id, u.create_date AS uploaded, s.*, z.prize_amount,
                (SELECT max(rv.modify_date) FROM src_review rv JOIN src_scorecard sc ON sc.scorecard_id = rv.scorecard_id AND sc.scorecard_type_id IN (2, 8)
                 WHERE rv.submission_id = s.submission_id AND rv.committed = 1) AS reviewed
         FROM src_submission s JOIN src_upload u ON u.upload_id = s.upload_id LEFT JOIN src_prize z ON z.prize_id = s.prize_id WHERE s.submission_type_id = 1)"""

job("project_result",
    "project_id user_id submit_ind valid_submission_ind raw_score final_score inquire_timestamp submit_timestamp review_complete_timestamp payment old_rating new_rating "
    "old_reliability new_reliability placed rating_ind passed_review_ind reliable_submission_ind old_rating_id new_rating_id num_ratings rating_order num_appeals num_successful_appeals", f"""
WITH touched AS ({_with_component(True, _LOADED)}), {_SENT},
e AS (SELECT project_id, resource_id, max(CASE WHEN submission_status_id IN (1, 2, 3, 4) THEN 1 ELSE 0 END) AS sub,
        max(CASE WHEN submission_status_id IN (1, 2, 3, 4) AND placement = 1 AND final_score = 100 THEN 1 ELSE 0 END) AS won,
        max(initial_score) FILTER (submission_status_id IN (1, 2, 3, 4) AND placement = 1) AS raw, max(final_score) FILTER (submission_status_id IN (1, 2, 3, 4) AND placement = 1) AS fin,
        max(prize_amount) FILTER (submission_status_id IN (1, 2, 3, 4) AND placement = 1 AND final_score = 100) AS prize,
        max(uploaded) FILTER (submission_status_id <> 5) AS up, max(reviewed) FILTER (submission_status_id <> 5) AS rev FROM sent GROUP BY 1, 2),
base AS (
  SELECT pr.*, p.project_category_id = 38 AS s38, coalesce(e.sub, 0) AS sub, coalesce(e.won, 0) AS won, e.raw, e.fin, e.prize, e.up, e.rev, d.phase_id, d.rating_date,
         (SELECT max(create_time) FROM src_component_inquiry q WHERE q.project_id = pr.project_id AND q.user_id = pr.user_id) AS inq,
         (SELECT max(value) FROM src_resource_info x WHERE x.resource_id = r.resource_id AND x.resource_info_type_id = 6) AS reg,
         y.reliability_before_resolution AS ra, y.reliability_after_resolution AS rb, y.reliable_ind
  FROM src_project_result pr JOIN touched t ON t.project_id = pr.project_id JOIN src_project p ON p.project_id = pr.project_id
  JOIN src_resource r ON r.project_id = pr.project_id AND r.resource_role_id = 1 AND r.user_id = pr.user_id
  LEFT JOIN e ON e.project_id = pr.project_id AND e.resource_id = r.resource_id
  LEFT JOIN src_project_reliability y ON y.project_id = pr.project_id AND y.user_id = pr.user_id
  LEFT JOIN dw_project d ON d.project_id = pr.project_id
  WHERE EXISTS (SELECT 1 FROM src_project_info i JOIN src_comp_catalog c ON CAST(c.component_id AS VARCHAR) = i.value WHERE i.project_id = p.project_id AND i.project_info_type_id = 2))
SELECT b.project_id, b.user_id, sub, CASE WHEN s38 THEN won WHEN sub = 1 THEN valid_submission_ind ELSE 0 END, CASE WHEN s38 THEN raw ELSE raw_score END,
  CASE WHEN s38 THEN fin ELSE final_score END, coalesce(inq, TRY_CAST(reg AS TIMESTAMP)), up, rev, CASE WHEN s38 THEN prize ELSE payment END, old_rating, new_rating, ra, rb,
  CASE WHEN placed IS NULL AND s38 AND won = 1 THEN 1 ELSE placed END, rating_ind, CASE WHEN s38 THEN won ELSE passed_review_ind END, coalesce(reliable_ind, 0),
  coalesce(old_rating, -2), coalesce(new_rating, -2),
  rating_ind + CASE WHEN rating_date IS NULL THEN 0 ELSE coalesce(sum(CASE WHEN rating_date IS NOT NULL THEN rating_ind END)
      OVER (PARTITION BY b.user_id, phase_id ORDER BY rating_date NULLS FIRST, b.project_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END,
  rating_order, a.n, a.ok
FROM base b LEFT JOIN (SELECT project_id, user_id, sum(num_appeals) AS n, sum(num_successful_appeals) AS ok FROM dw_submission_review GROUP BY 1, 2) a
  ON a.project_id = b.project_id AND a.user_id = b.user_id""", targets={"project": "dw_project", "submission_review": "dw_submission_review"})

_STUDIO = (
    "(SELECT * FROM src_project WHERE project_status_id NOT IN (1, 2, 3, 9, 10, 11) "
    "AND project_category_id IN (SELECT project_category_id FROM src_project_category_lu WHERE project_type_id = 3)) p"
)

job("design_project_result",
    "project_id user_id submission_id upload_id prize_id prize_amount placement dr_points is_checkpoint client_selection submit_timestamp review_complete_timestamp "
    "inquire_timestamp submit_ind valid_submission_ind", f"""
WITH touched AS ({_with_component(False, _STUDIO, False)}),
shares AS ({_SHARES}),
marks AS (SELECT u.project_id, count(*) AS n FROM src_submission s JOIN src_upload u ON u.upload_id = s.upload_id JOIN src_prize z ON z.prize_id = s.prize_id
          WHERE s.submission_type_id = 1 AND (s.mark_for_purchase IS NULL OR NOT s.mark_for_purchase) GROUP BY 1),
base AS (
  SELECT r.project_id, r.user_id, s.submission_id, u.upload_id, z.prize_id, z.prize_amount, s.placement, s.submission_type_id = 3 AS ck, coalesce(s.mark_for_purchase, FALSE) AS mk,
         u.create_date AS up, r.create_date AS inq, s.submission_status_id AS st, (SELECT max(v.modify_date) FROM src_review v WHERE v.submission_id = s.submission_id AND v.committed = 1) AS rev,
         CASE WHEN {_info(26)} = 'On' THEN coalesce(TRY_CAST({_info(30)} AS DECIMAL(18,2)), 0) ELSE 0 END::DOUBLE AS total, coalesce(m.n, 0) AS n
  FROM touched p JOIN src_resource r ON r.project_id = p.project_id AND r.resource_role_id = 1
  LEFT JOIN src_upload u ON u.project_id = p.project_id AND u.resource_id = r.resource_id AND u.upload_status_id = 1 AND u.upload_type_id = 1
  LEFT JOIN src_submission s ON s.upload_id = u.upload_id AND s.submission_status_id <> 5 AND s.submission_type_id IN (1, 3)
  LEFT JOIN src_prize z ON z.prize_id = s.prize_id LEFT JOIN marks m ON m.project_id = p.project_id)
SELECT project_id, user_id, coalesce(submission_id, 0), CASE WHEN submission_id IS NOT NULL THEN upload_id END, prize_id, prize_amount,
  CASE WHEN submission_id IS NOT NULL AND NOT ck AND NOT mk THEN placement END,
  CASE WHEN NOT ck AND NOT mk AND prize_id IS NOT NULL THEN CASE WHEN total > 0 AND b.n > 0 THEN coalesce(floor(total * share * 100.0 + 0.5) / 100.0, 0) ELSE 0 END END,
  CASE WHEN submission_id IS NOT NULL THEN CAST(ck AS INTEGER) END, CASE WHEN submission_id IS NOT NULL THEN CAST(mk AS INTEGER) END,
  CASE WHEN submission_id IS NOT NULL THEN up END, rev, inq, CASE WHEN submission_id IS NOT NULL THEN 1 ELSE 0 END, CASE WHEN st IN (1, 4) THEN 1 ELSE 0 END
FROM base b LEFT JOIN shares h ON h.n = least(b.n, 5) AND h.p = b.placement
WHERE submission_id IS NOT NULL OR upload_id IS NULL""")

_PAID = f"(d.date_modified > {H} OR d.create_date > {H} OR t.modify_date > {H} OR t.create_date > {H})"
_REFERENCE = "CASE t.payment_reference_id " + " ".join(f"WHEN {k} THEN d.{v}" for k, v in fixed.PAYMENT_REFERENCES.items()) + " END"
_PAYMENT_TARGETS = {"calendar": "dw_calendar", "time": "dw_time"}
_PAYMENT_FROM = f"""
FROM src_payment_detail d JOIN src_payment m ON m.most_recent_detail_id = d.payment_detail_id JOIN src_payment_type_lu t ON t.payment_type_id = d.payment_type_id
JOIN src_payment_status_lu s ON s.payment_status_id = d.payment_status_id"""

job("payment", "payment_id payment_desc payment_type_id payment_type_desc reference_id parent_payment_id charity_ind show_in_profile_ind show_details_ind payment_status_id "
    "payment_status_desc client modified_calendar_id modified_time_id installment_number jira_ticket_id created_calendar_id created_time_id", f"""
SELECT m.payment_id, payment_desc, d.payment_type_id, payment_type_desc, CASE WHEN {_REFERENCE} > 0 THEN {_REFERENCE} END, coalesce(parent_payment_id, 0), charity_ind, show_in_profile_ind,
  show_details_ind, d.payment_status_id, payment_status_desc, client, a.calendar_id, hour(d.date_modified) * 60 + minute(d.date_modified), installment_number, jira_issue_id,
  c.calendar_id, hour(d.create_date) * 60 + minute(d.create_date)
{_PAYMENT_FROM} JOIN dw_calendar a ON CAST(a.date AS DATE) = CAST(d.date_modified AS DATE) JOIN dw_calendar c ON CAST(c.date AS DATE) = CAST(d.create_date AS DATE)
WHERE d.payment_status_id <> 69 AND {_PAID}""", targets=_PAYMENT_TARGETS)

job("payment", "payment_id user_id net_amount gross_amount due_calendar_id paid_calendar_id total_amount", f"""
SELECT m.payment_id, d.user_id, net_amount, gross_amount, a.calendar_id, c.calendar_id, total_amount
{_PAYMENT_FROM} LEFT JOIN dw_calendar a ON CAST(a.date AS DATE) = CAST(d.date_due AS DATE) LEFT JOIN dw_calendar c ON CAST(c.date AS DATE) = CAST(d.date_paid AS DATE)
WHERE d.payment_status_id <> 69 AND {_PAID}""", table="user_payment", targets=_PAYMENT_TARGETS)

_DAY = "CAST(date_trunc('day', {}) AS TIMESTAMP)"
job("participation", "user_id participation_type participation_date", f"""
SELECT rr.coder_id, 1, {_DAY.format('g.start_time')} FROM src_round r JOIN src_room_result rr ON rr.round_id = r.round_id AND attended = 'Y' AND room_seed IS NOT NULL
JOIN src_round_segment g ON g.round_id = r.round_id AND segment_id = 1 WHERE round_type_id IN (1, 2, 10) AND g.start_time > {H}
UNION
SELECT l.coder_id, 2, {_DAY.format('g.start_time')} FROM src_round r JOIN src_long_comp_result l ON l.round_id = r.round_id AND attended = 'Y'
JOIN src_round_segment g ON g.round_id = r.round_id AND segment_id = 1 WHERE round_type_id IN (13, 15, 19, 22, 25) AND g.start_time > {H}
UNION
SELECT CAST(i.value AS BIGINT), CASE WHEN c.project_type_id IN (1, 2) THEN 3 ELSE 4 END, {_DAY.format('r.create_date')}
FROM src_resource r JOIN src_resource_info i ON i.resource_id = r.resource_id AND i.resource_info_type_id = 1 JOIN src_project p ON p.project_id = r.project_id
JOIN src_project_category_lu c ON c.project_category_id = p.project_category_id AND c.project_type_id IN (1, 2, 3)
WHERE r.resource_role_id IN (1, 2, 4, 5, 6, 7, 8, 9) AND r.create_date > {H} AND NOT EXISTS (SELECT 1 FROM src_contest_eligibility e WHERE e.contest_id = r.project_id)""")

job("user_rating", "user_id rating phase_id vol rating_no_vol num_ratings mod_date_time create_date_time last_rated_project_id highest_rating lowest_rating", f"""
SELECT u.user_id, rating, u.phase_id, vol, rating_no_vol, num_ratings, TIMESTAMP '2001-08-01', TIMESTAMP '2001-08-01', last_rated_project_id, coalesce(hi, 0), coalesce(lo, 0)
FROM src_user_rating u LEFT JOIN (
  SELECT pr.user_id, p.project_category_id + 111 AS phase_id, max(new_rating) AS hi, min(new_rating) AS lo FROM src_project_result pr JOIN src_project p ON p.project_id = pr.project_id
  WHERE rating_ind = 1 AND {ELIGIBLE} GROUP BY 1, 2) x ON x.user_id = u.user_id AND x.phase_id = u.phase_id WHERE mod_date_time > TIMESTAMP '2001-07-01'""", hwm=datetime(2001, 7, 1))

# --- derived --------------------------------------------------------------------

_RANK_TARGETS = {"user_rating": "dw_user_rating", "coder": "dw_coder", "project": "dw_project"}
_RATED = f"""
WITH r AS (
  SELECT u.user_id, u.phase_id, u.rating, CASE WHEN c.coder_type_id <> 2 THEN s.school_id END AS school_id, c.comp_country_code AS country_code,
         EXISTS (SELECT 1 FROM dw_project p WHERE p.project_id = u.last_rated_project_id AND p.phase_id = u.phase_id AND p.posting_date > TIMESTAMP '2001-08-01' - INTERVAL 180 DAY) AS active
  FROM dw_user_rating u JOIN dw_coder c ON c.coder_id = u.user_id AND c.status = 'A' LEFT JOIN src_current_school s ON s.coder_id = u.user_id
  WHERE u.phase_id IN ({', '.join(str(c + fixed.PHASE_OFFSET) for c in fixed.RATED_CATEGORIES)})),
typed AS (SELECT *, 1 AS kind FROM r UNION ALL SELECT *, 2 FROM r WHERE active)"""


def _rank_sql(keys: str, position: bool, where: str = "TRUE") -> str:
    group = f"PARTITION BY kind, phase_id{', ' + keys if keys else ''}"
    rank = f"rank() OVER ({group} ORDER BY rating DESC)"
    total = f"count(*) OVER ({group})"
    place = f", row_number() OVER ({group} ORDER BY rating DESC, user_id)" if position else ""
    return _RATED + f" SELECT user_id, phase_id{', ' + keys if keys else ''}, {rank}{place}, round(100 * (({total} - {rank})::DOUBLE / {total}), 4), kind FROM typed WHERE {where}"


job("user_rank", "user_id phase_id rank percentile user_rank_type_id", _rank_sql("", False), targets=_RANK_TARGETS)
job("user_rank", "user_id phase_id school_id rank rank_no_tie percentile user_rank_type_id", _rank_sql("school_id", True, "school_id > 0"), table="school_user_rank", targets=_RANK_TARGETS)
job("user_rank", "user_id phase_id country_code rank rank_no_tie percentile user_rank_type_id", _rank_sql("country_code", True), table="country_user_rank", targets=_RANK_TARGETS)

job("streak", "coder_id streak_type_id phase_id start_project_id end_project_id length is_current", """
WITH r AS (
  SELECT pr.user_id, p.phase_id, pr.project_id, pr.rating_order, coalesce(pr.placed, 0) AS pl, coalesce(round(pr.new_rating), 0) AS ra,
         lag(coalesce(round(pr.new_rating), 0)) OVER (PARTITION BY pr.user_id, p.phase_id ORDER BY pr.rating_order, pr.project_id) AS prev
  FROM dw_project_result pr JOIN dw_project p ON p.project_id = pr.project_id
  WHERE pr.valid_submission_ind = 1 AND pr.rating_ind = 1 AND p.status_id IN (4, 5, 7) AND p.phase_id IN (112, 113)),
k AS (SELECT *, 1 AS kind, pl = 1 AS ok FROM r UNION ALL SELECT *, 2, pl IN (1, 2) FROM r
      UNION ALL SELECT *, 3, coalesce(prev >= 0 AND ra > prev, FALSE) FROM r UNION ALL SELECT *, 4, coalesce(prev >= 0 AND ra < prev, FALSE) FROM r),
i AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY kind, user_id, phase_id ORDER BY rating_order, project_id) AS island,
             sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY kind, user_id, phase_id) AS final FROM k)
SELECT user_id, kind, phase_id, min_by(project_id, rating_order), max_by(project_id, rating_order), count(*), max(CASE WHEN island = final THEN 1 ELSE 0 END)
FROM i WHERE ok GROUP BY kind, user_id, phase_id, island HAVING count(*) > 1""", targets={"project": "dw_project", "project_result": "dw_project_result"})

job("dr_points", "dr_points_id track_id dr_points_reference_type_id dr_points_reference_type_desc dr_points_operation_id dr_points_operation_desc dr_points_type_id dr_points_type_desc "
    "dr_points_status_id dr_points_status_desc dr_points_desc user_id amount application_date award_date reference_id is_potential", """
SELECT p.dr_points_id, p.track_id, p.dr_points_reference_type_id, 'points reference', p.dr_points_operation_id, 'points operation', 1, 'points type', 1, 'points status', p.dr_points_desc, p.user_id,
  CASE WHEN p.dr_points_operation_id = 2 THEN coalesce(CASE WHEN p.dr_points_reference_type_id = 2 THEN q.amount ELSE 0 END, 0) * p.amount / 100 ELSE p.amount END,
  p.application_date, p.award_date, coalesce(p.reference_id, 0), p.is_potential
FROM src_dr_points p LEFT JOIN src_dr_points q ON q.dr_points_id = p.reference_id
WHERE p.track_id IN (SELECT track_id FROM src_dr_points WHERE modify_date > TIMESTAMP '2024-01-30' OR create_date > TIMESTAMP '2024-01-30')""", hwm=datetime(2024, 1, 30))

job("track_contest_results", "track_contest_id user_id track_contest_placement track_contest_prize taxable_track_contest_prize", """
WITH c AS (SELECT t.track_contest_id, t.track_id, l.class_name FROM src_track_contest t JOIN src_track_contest_type_lu y ON y.track_contest_type_id = t.track_contest_type_id
           JOIN src_track_contest_result_calculator_lu l ON l.track_contest_result_calculator_id = t.track_contest_result_calculator_id
           WHERE t.track_id IN (SELECT track_id FROM src_dr_points WHERE modify_date > TIMESTAMP '2024-01-10' OR create_date > TIMESTAMP '2024-01-10')),
pts AS (SELECT d.track_id, d.user_id, d.amount, d.is_potential, coalesce(pr.placed, 0) AS placed, pr.project_id IS NOT NULL AND coalesce(pr.payment, 0) = 0 AS tax
        FROM dw_dr_points d LEFT JOIN dw_project_result pr ON d.dr_points_reference_type_id = 1 AND pr.project_id = d.reference_id AND pr.user_id = d.user_id),
tot AS (SELECT c.track_contest_id, user_id,
          sum(CASE WHEN is_potential THEN 0 ELSE amount END * CASE WHEN class_name = 'top_performers' AND placed = 1 THEN 2 ELSE 1 END) AS fin,
          sum(CASE WHEN is_potential OR NOT tax THEN 0 ELSE amount END * CASE WHEN class_name = 'top_performers' AND placed = 1 THEN 2 ELSE 1 END) AS taxable
        FROM pts JOIN c ON c.track_id = pts.track_id GROUP BY 1, 2),
k AS (SELECT *, rank() OVER (PARTITION BY track_contest_id ORDER BY fin DESC) AS place FROM tot)
SELECT track_contest_id, user_id, k.place, CASE WHEN fin > 0 THEN z.prize_amount END,
  CASE WHEN fin > 0 THEN z.prize_amount::DOUBLE * (taxable::DOUBLE / fin::DOUBLE) END
FROM k LEFT JOIN src_contest_prize z ON z.contest_id = k.track_contest_id AND z.place = k.place""",
    hwm=datetime(2024, 1, 10), targets={"dr_points": "dw_dr_points", "project_result": "dw_project_result"}, options={"track_prizes": "contest_prize"})

_POSTED = """
posted AS (SELECT project_id, coalesce(max(actual_start_time) FILTER (phase_type_id = 1), max(actual_start_time) FILTER (phase_type_id = 2)) AS posted FROM src_project_phase GROUP BY 1)"""

job("contest_result", "contest_id coder_id initial_points final_points potential_points current_place current_prize", f"""
WITH {_POSTED}, shares AS ({_SHARES}),
touched AS (SELECT DISTINCT s.stage_id FROM src_project p JOIN src_project_result pr ON pr.project_id = p.project_id JOIN posted d ON d.project_id = p.project_id
            JOIN src_stage s ON d.posted BETWEEN s.start_date AND s.end_date
            WHERE p.project_status_id <> 3 AND p.project_category_id IN {_CATEGORIES} AND {ELIGIBLE} AND (p.modify_date > {H} OR pr.modify_date > {H})),
contests AS (SELECT c.contest_id, c.project_category_id AS cat, l.class_name, x.top_performers_factor AS factor, s.start_date, s.end_date
             FROM src_contest_stage_xref x JOIN touched t ON t.stage_id = x.stage_id JOIN src_stage s ON s.stage_id = x.stage_id JOIN src_contest c ON c.contest_id = x.contest_id
             JOIN src_contest_result_calculator_lu l ON l.contest_result_calculator_id = c.contest_result_calculator_id),
r AS (
  SELECT c.contest_id, c.class_name, c.factor, pr.user_id, pr.placed, pr.point_adjustment AS adj, p.project_status_id AS st,
         coalesce(TRY_CAST({_info(30)} AS DECIMAL(18,2)), TRY_CAST({_info(16)} AS DECIMAL(18,2)))::DOUBLE AS amount,
         (SELECT count(*) FROM src_submission s JOIN src_upload u ON u.upload_id = s.upload_id WHERE u.project_id = p.project_id AND s.submission_type_id = 1 AND s.submission_status_id IN (1, 4)) AS n,
         CASE WHEN EXISTS (SELECT 1 FROM src_submission s JOIN src_upload u ON u.upload_id = s.upload_id JOIN src_resource_info i ON i.resource_id = u.resource_id AND i.resource_info_type_id = 1
              WHERE u.project_id = p.project_id AND i.value = CAST(pr.user_id AS VARCHAR) AND s.submission_type_id = 1 AND s.submission_status_id IN (1, 2, 3, 4)) THEN pr.valid_submission_ind ELSE 0 END AS valid
  FROM src_project p JOIN src_project_result pr ON pr.project_id = p.project_id JOIN posted d ON d.project_id = p.project_id
  JOIN contests c ON (p.project_category_id = c.cat OR (c.cat = 2 AND p.project_category_id = 5)) AND d.posted BETWEEN c.start_date AND c.end_date
  WHERE {_info(26)} = 'On' AND (pr.rating_ind = 1 OR p.project_category_id = 5) AND {ELIGIBLE}),
pts AS (
  SELECT r.*, CASE WHEN st IN (7, 8) THEN CASE WHEN amount > 0 AND r.n > 0 AND placed BETWEEN 1 AND 5 THEN floor(amount * a.share * 100.0 + 0.5) / 100.0 ELSE 0 END ELSE 0 END AS got,
         CASE WHEN st NOT IN (7, 8) AND valid = 1 AND amount > 0 AND r.n > 0 THEN floor(amount * b.share * 100.0 + 0.5) / 100.0 ELSE 0 END AS pot,
         CASE WHEN class_name = 'top_performers' AND placed = 1 THEN factor::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM r LEFT JOIN shares a ON a.n = least(r.n, 5) AND a.p = r.placed LEFT JOIN shares b ON b.n = least(r.n, 5) AND b.p = 1 WHERE valid = 1 OR st = 7),
tot AS (SELECT contest_id, user_id, sum(CAST(got * w AS DECIMAL(18,2))) AS ini, sum(CAST((got + adj) * w AS DECIMAL(18,2))) AS fin, sum(CAST(pot * w AS DECIMAL(18,2))) AS pot FROM pts GROUP BY 1, 2),
k AS (SELECT *, rank() OVER (PARTITION BY contest_id ORDER BY fin DESC) AS place FROM tot)
SELECT k.contest_id, user_id, ini, fin, pot, k.place, CASE WHEN fin > 0 THEN z.prize_amount END FROM k LEFT JOIN src_contest_prize z ON z.contest_id = k.contest_id AND z.place = k.place""")

job("tcd_project_stat", "direct_project_id project_category_id stat_date cost duration fulfillment total_project", """
SELECT tc_direct_project_id, project_category_id, CAST(date_trunc('day', complete_date) AS TIMESTAMP), sum(admin_fee + contest_prizes_total),
  sum(date_diff('second', posting_date, complete_date) // 60), sum(CASE WHEN status_id = 7 THEN 1 ELSE 0 END), count(*)
FROM dw_project WHERE complete_date IS NOT NULL AND tc_direct_project_id > 0 AND posting_date IS NOT NULL GROUP BY 1, 2, 3""", targets={"project": "dw_project"})

job("result_points", "dr_points_id track_id user_id amount application_date award_date reference_id is_potential", f"""
WITH touched AS ({_with_component(True, _LOADED)}), shares AS ({_SHARES}),
phases AS (SELECT project_id, coalesce(max(actual_start_time) FILTER (phase_type_id = 1), max(actual_start_time) FILTER (phase_type_id = 2)) AS posted,
                  max(coalesce(actual_end_time, scheduled_end_time)) FILTER (phase_type_id IN (6, 21)) AS announced FROM src_project_phase GROUP BY 1),
r AS (
  SELECT pr.project_id, pr.user_id, pr.placed, pr.point_adjustment AS adj, pr.valid_submission_ind AS valid, p.project_status_id AS st, p.project_category_id AS cat, h.posted, h.announced,
         coalesce(TRY_CAST({_info(30)} AS DECIMAL(18,2)), TRY_CAST({_info(16)} AS DECIMAL(18,2)))::DOUBLE AS amount,
         (SELECT count(*) FROM src_submission s JOIN src_upload u ON u.upload_id = s.upload_id WHERE u.project_id = p.project_id AND s.submission_type_id = 1 AND s.submission_status_id IN (1, 4)) AS n
  FROM src_project_result pr JOIN touched t ON t.project_id = pr.project_id JOIN src_project p ON p.project_id = pr.project_id JOIN phases h ON h.project_id = p.project_id
  WHERE {_info(26)} = 'On' AND p.project_status_id IN (1, 7, 8)),
k AS (
  SELECT t.track_id, r.*, l.class_name FROM r JOIN src_track_project_category_xref x ON x.project_category_id = r.cat
  JOIN src_track t ON t.track_id = x.track_id AND t.track_status_id = 1 AND r.posted BETWEEN t.track_start_date AND t.track_end_date
  JOIN src_points_calculator_lu l ON l.points_calculator_id = t.points_calculator_id),
g AS (
  SELECT k.*, CASE WHEN class_name = 'winner_takes_all' THEN CASE WHEN placed = 1 OR st = 1 THEN amount ELSE 0 END
                   WHEN amount > 0 AND k.n > 0 AND (st = 1 OR placed BETWEEN 1 AND 5) THEN floor(amount * s.share * 100.0 + 0.5) / 100.0 ELSE 0 END AS raw
  FROM k LEFT JOIN shares s ON s.n = least(k.n, 5) AND s.p = CASE WHEN st = 1 THEN 1 ELSE placed END),
f AS (SELECT *, CAST(raw + adj AS DECIMAL(10,2)) AS gain FROM (SELECT * REPLACE (CASE WHEN st = 1 AND valid <> 1 THEN 0 ELSE raw END AS raw) FROM g) y WHERE st <> 1 OR valid = 1)
SELECT row_number() OVER (ORDER BY track_id, project_id, user_id), track_id, user_id, gain, posted, CASE WHEN st IN (7, 8) THEN announced END, project_id, st = 1
FROM f WHERE gain > 0""")

for _table, _key, _duck in (("project_result", "project_id", "dw_project_result"), ("user_rating", "last_rated_project_id", "dw_user_rating")):
    _columns = {"project_result": "project_id user_id placed rating_ind", "user_rating": "user_id phase_id rating last_rated_project_id"}[_table]
    job("deleted_projects", _columns, f"""
SELECT {', '.join(_columns.split())} FROM {_duck} WHERE {_key} NOT IN (SELECT project_id FROM src_project WHERE project_status_id = 3)""",
        table=_table, targets={_table: _duck}, name=f"load_deleted_{_table}")

# --- loads on older states -------------------------------------------------------

# Left out: loads that replace a whole table, look at changed projects only once they have run, or change rows beside.
for _name, _keys in {
    "load_contest": "contest_id", "load_contest_prize": "contest_prize_id", "load_track": "track_id", "load_track_contest": "track_contest_id",
    "load_coder": "coder_id", "load_client_project_dim": "billing_project_id client_project_id", "load_direct_project_dim": "direct_project_id",
    "load_evaluation_lu": "evaluation_id", "load_event": "event_id", "load_event_registration": "event_id user_id",
    "load_user_event_xref": "event_id user_id", "load_season": "season_id", "load_stage": "stage_id",
    "load_scorecard_template": "scorecard_template_id", "load_scorecard_question": "scorecard_question_id",
    "load_user_contest_prize": "user_id contest_id prize_type_id place", "load_user_reliability": "user_id phase_id",
    "load_royalty": "user_id royalty_date description",
    "load_projects": "id", "load_project_members": "id", "load_project": "project_id",
    "load_appeal": "appeal_id", "load_testcase_appeal": "appeal_id", "load_testcase_response": "scorecard_id scorecard_question_id",
    "load_scorecard_response": "scorecard_id scorecard_question_id", "load_subjective_response": "scorecard_id scorecard_question_id",
    "load_submission_review": "project_id user_id reviewer_id", "load_submission_screening": "project_id user_id",
    "load_payment": "payment_id", "load_user_payment": "payment_id user_id",
    "load_dr_points": "track_id dr_points_id", "load_contest_result": "contest_id coder_id",
    "load_track_contest_results": "track_contest_id user_id",
}.items():
    on_older_state(_name, _keys)

_CHANGED_PROJECTS = f"SELECT project_id FROM src_project WHERE create_date > {H} OR modify_date > {H}"
on_filled_target("load_project_platform", "project_id project_platform_id", _CHANGED_PROJECTS)
on_filled_target("load_project_technology", "project_id project_technology_id", _CHANGED_PROJECTS)
on_filled_target("load_design_project_result", "project_id user_id submission_id", _with_component(False, _STUDIO))
on_filled_target("load_marathon_match", "project_id", f"""
SELECT project_id FROM src_project WHERE modify_date > {H}
UNION SELECT i.project_id FROM src_project_info i JOIN src_comp_versions v ON CAST(v.comp_vers_id AS VARCHAR) = i.value
      WHERE i.project_info_type_id = 1 AND v.modify_date > {H}
UNION SELECT project_id FROM src_project_info WHERE project_info_type_id IN (2, 3, 21, 22, 23, 26, 31, 32, 56, 57) AND (create_date > {H} OR modify_date > {H})
UNION SELECT i.project_id FROM src_project_info i JOIN src_payment_detail d ON CAST(d.algorithm_round_id AS VARCHAR) = i.value
      JOIN src_payment m ON m.most_recent_detail_id = d.payment_detail_id
      WHERE i.project_info_type_id = 56 AND d.payment_status_id NOT IN (65, 69) AND (d.create_date > {H} OR d.date_modified > {H} OR m.create_date > {H} OR m.modify_date > {H})""")


def _backfill(name: str, filled: dict[str, str]):
    """Register project_backfill on projects whose late columns are empty, but for the ``filled`` ones (column to SQL value)."""
    from loadstone.plans.projects import LATE_COLUMNS

    known = JOBS["load_project"]
    names, types = known["names"], known["types"]
    late = {c: group for group, (columns, _) in LATE_COLUMNS.items() for c in columns}
    closed = {late[c] for c in filled}

    def emptied(spark, folder, views):
        full = context(spark, folder, known["hwm"], known["targets"], known["options"], views)
        rows = settle_alone(lambda: all_loads()["project"].run(full)["project"].rows)
        value = lambda c: F.expr(filled.get(c, "NULL")).cast(types[c]).alias(c)
        return rows.select(*[value(f.name) if f.name in late else F.col(f.name) for f in rows.schema])

    def run(spark, folder):
        ctx = context(spark, folder, known["hwm"], {**known["targets"], "project": emptied}, known["options"])
        rows = all_loads()["project_backfill"].run(ctx)["project"].rows
        return rows.select(*[_spark_column(c, types[c]) for c in names])

    run.__name__ = name
    run.__doc__ = "The project table after its late columns are filled."

    def column(c: str) -> str:
        if late.get(c) in closed:
            return f"{filled.get(c, 'NULL')} AS {c}"
        if c == "estimated_review_cost":
            return f"{_money(_info(33))} AS {c}"
        return f"CASE WHEN p.status_id = 7 THEN p.{c} END AS {c}" if late.get(c) == "costs" else f"p.{c}"

    listed = ", ".join(_duck_column(c, types[c]) for c in names)
    add(name, run, world.duck_sql(
        f"WITH result({', '.join(names)}) AS MATERIALIZED ({known['sql']}) SELECT {listed} FROM (SELECT {', '.join(map(column, names))} FROM result p)"
    ))


_backfill("load_project_backfill", {})
_backfill("load_project_backfill_partly", {"challenge_creator": "-1"})
