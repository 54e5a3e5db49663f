"""Source and warehouse tables of a contest platform, derived from the test tables.

The loads read tables the test data does not have. Each is a view over the
test tables here, so a job's work grows with them. The SQL is plain enough
for Spark and DuckDB alike; ``EACH(a, b)`` makes one row per listed value.

Orders play the projects, (order, supplier) pairs of the lines the entries of a
user in a project, customers the users, parts the components, events the
points, documents the review questions.
"""

from __future__ import annotations

import re
import zlib
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from loadstone.functions import fixed
from loadstone.session import lasting, settle

BASE = "nation region customer supplier part orders lineitem events documents".split()

# Tables that cost an exchange and that most others are views of, or that a load and its older state both look up: worked out once per query.
SHARED = ("src_entry", "src_comp_catalog", "src_comp_versions", "dw_calendar")

# A reviewer's resource id lies above every submitter's.
_STAFF = 900000000000000

TABLES: dict[str, str] = {
    # one row per user and project
    "src_entry": """
        SELECT l_orderkey AS project_id, l_suppkey AS user_id, l_orderkey * 1000000 + l_suppkey AS resource_id,
               max(l_quantity) AS q, min(l_linenumber) AS ln, max(l_shipdate) AS d, min(l_extendedprice) AS price,
               max(l_discount) AS disc, max(l_tax) AS tax, max(l_returnflag) AS rf
        FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "src_project": """
        SELECT o_orderkey AS project_id,
               CASE o_custkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 37 WHEN 4 THEN 38 WHEN 5 THEN 16 WHEN 6 THEN 27 ELSE 39 END AS project_category_id,
               CASE WHEN o_orderstatus = 'F' THEN 7 WHEN o_orderstatus = 'O' THEN 1 WHEN o_totalprice < 100000 THEN 3
                    WHEN o_totalprice < 200000 THEN 8 WHEN o_totalprice < 300000 THEN 4 ELSE 7 END AS project_status_id,
               o_custkey % 50 AS tc_direct_project_id, o_custkey + 7 AS create_user, o_orderdate - INTERVAL '10' DAY AS create_date,
               o_orderdate AS modify_date, CASE WHEN o_orderpriority = '5-LOW' THEN 'Converter' ELSE 'user' END AS modify_user
        FROM orders""",
    "src_contest_eligibility": """
        SELECT o_orderkey AS contest_id, CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END AS is_studio
        FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice > 300000""",
    "src_project_info_raw": """
        SELECT o_orderkey AS project_id, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus,
               EACH(1, 2, 4, 16, 21, 22, 23, 26, 30, 31, 32, 33, 35, 38, 45, 49, 53, 56, 57, 58, 82) AS project_info_type_id
        FROM orders""",
    "src_project_info": """
        SELECT * FROM (
          SELECT project_id, project_info_type_id,
            CASE project_info_type_id
              WHEN 1 THEN CAST(o_custkey AS STRING) WHEN 2 THEN CAST(o_custkey AS STRING) WHEN 4 THEN CAST(project_id + 7 AS STRING)
              WHEN 16 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)
              WHEN 21 THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'soon' ELSE CAST(o_orderdate + INTERVAL '40' DAY AS STRING) END
              WHEN 22 THEN CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate + INTERVAL '1' DAY * (30 + o_custkey % 20) AS STRING) END
              WHEN 23 THEN CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey + 3 AS STRING) END
              WHEN 26 THEN CASE WHEN o_totalprice < 250000 THEN 'On' WHEN o_totalprice < 350000 THEN 'Yes' ELSE 'Off' END
              WHEN 30 THEN CASE WHEN o_custkey % 3 > 0 THEN CAST(450 + o_custkey % 100 AS STRING) END
              WHEN 31 THEN CAST(CAST(floor(o_totalprice / 100) AS DECIMAL(18,2)) AS STRING)
              WHEN 32 THEN CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(o_custkey % 20 AS STRING) END
              WHEN 33 THEN '12.50' WHEN 35 THEN CASE WHEN o_orderstatus = 'F' THEN '30' END WHEN 38 THEN '99.99'
              WHEN 45 THEN CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END
              WHEN 49 THEN CASE WHEN o_orderstatus = 'P' THEN '150' END
              WHEN 53 THEN CASE WHEN o_custkey % 2 = 1 THEN 'true' WHEN o_custkey % 4 = 2 THEN 'false' END
              WHEN 56 THEN CAST(o_custkey AS STRING)
              WHEN 57 THEN CASE WHEN o_custkey % 3 = 1 THEN '0.15' END
              WHEN 58 THEN CAST(o_custkey + 2 AS STRING)
              WHEN 82 THEN CASE WHEN o_orderpriority = '3-MEDIUM' THEN '1' END
            END AS value,
            o_orderdate - INTERVAL '10' DAY AS create_date, o_orderdate + INTERVAL '2' DAY AS modify_date,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'Converter' ELSE 'user' END AS modify_user
          FROM src_project_info_raw) x WHERE value IS NOT NULL""",
    "src_project_category_lu": """
        SELECT project_category_id, CASE project_category_id WHEN 1 THEN 'Design' WHEN 2 THEN 'Development' WHEN 5 THEN 'Testing' WHEN 37 THEN 'Match'
               WHEN 38 THEN 'Sprint' WHEN 16 THEN 'Banners' WHEN 27 THEN 'Review' ELSE 'Code' END AS name,
               CASE WHEN project_category_id IN (16, 27) THEN 3 WHEN project_category_id < 3 THEN 1 ELSE 2 END AS project_type_id
        FROM (SELECT EACH(1, 2, 5, 16, 27, 37, 38, 39) AS project_category_id FROM region WHERE r_regionkey = 0) x""",
    "src_project_status_lu": """
        SELECT project_status_id, 'status ' || CAST(project_status_id AS STRING) AS name
        FROM (SELECT EACH(1, 3, 4, 5, 7, 8) AS project_status_id FROM region WHERE r_regionkey = 0) x""",
    "src_phase_type_lu": """
        SELECT phase_type_id, 'phase ' || CAST(phase_type_id AS STRING) AS name
        FROM (SELECT EACH(1, 2, 4, 6, 10, 11, 15, 17) AS phase_type_id FROM region WHERE r_regionkey = 0) x""",
    "src_project_phase": """
        SELECT project_id * 100 + phase_type_id AS project_phase_id, project_id, phase_type_id,
               CASE WHEN o_orderstatus = 'O' AND phase_type_id > 2 THEN 2 WHEN o_orderstatus = 'P' AND phase_type_id = 4 THEN 2 ELSE 3 END AS phase_status_id,
               o_orderdate + INTERVAL '1' DAY * phase_type_id AS scheduled_start_time,
               o_orderdate + INTERVAL '1' DAY * (phase_type_id + 4) AS scheduled_end_time,
               CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderdate + INTERVAL '1' HOUR * (phase_type_id * 24 + 5) END AS actual_start_time,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL '1' HOUR * (phase_type_id * 24 + o_custkey % 70) END AS actual_end_time
        FROM (SELECT o_orderkey AS project_id, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, EACH(1, 2, 4, 6, 10, 11, 15, 17) AS phase_type_id FROM orders) x
        WHERE NOT (phase_type_id IN (15, 17) AND o_orderpriority = '1-URGENT')""",
    "src_categories": "SELECT n_nationkey AS category_id, n_name AS category_name, n_regionkey % 2 AS viewable FROM nation",
    "src_comp_catalog": """
        SELECT p_partkey AS component_id, p_name AS component_name, p_size % 25 AS root_category_id, o_orderdate AS modify_date
        FROM part JOIN orders ON o_orderkey = p_partkey""",
    "src_comp_versions": """
        SELECT p_partkey AS comp_vers_id, p_partkey AS component_id, CASE WHEN p_brand = 'Brand#1' THEN 1000 ELSE p_size END AS version,
               'v' || CAST(p_size AS STRING) AS version_text, p_size % 2 AS suspended_ind, o_orderdate AS modify_date
        FROM part JOIN orders ON o_orderkey = p_partkey""",
    "src_comp_technology": "SELECT p_partkey AS comp_vers_id, technology_type_id FROM (SELECT p_partkey, p_size, EACH(1, 2, 3) AS technology_type_id FROM part) x WHERE p_size > technology_type_id * 10",
    "src_technology_types": "SELECT EACH(1, 2, 3) AS technology_type_id, 'tech' AS technology_name FROM region WHERE r_regionkey = 0",
    "src_project_platform": "SELECT o_orderkey AS project_id, o_custkey % 5 AS project_platform_id FROM orders WHERE o_totalprice > 150000",
    "src_project_platform_lu": "SELECT r_regionkey AS project_platform_id, r_name AS name FROM region",
    "src_resource": f"""
        SELECT resource_id, project_id, user_id, 1 AS resource_role_id, d - INTERVAL '60' DAY AS create_date, d - INTERVAL '50' DAY AS modify_date, 'user' AS modify_user FROM src_entry
        UNION ALL
        SELECT {_STAFF} + o_orderkey * 20 + role, o_orderkey, o_custkey + role, role, o_orderdate, o_orderdate + INTERVAL '1' DAY, CASE WHEN o_orderpriority = '5-LOW' THEN 'Converter' ELSE 'user' END
        FROM (SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, EACH(2, 4, 5, 6, 7, 9, 13, 14) AS role FROM orders) x""",
    "src_resource_info": """
        SELECT resource_id, 1 AS resource_info_type_id, CAST(user_id AS STRING) AS value, modify_date, modify_user FROM src_resource
        UNION ALL
        SELECT resource_id, 6, CAST(create_date AS STRING), modify_date, modify_user FROM src_resource WHERE resource_role_id = 1""",
    "src_upload": """
        SELECT resource_id AS upload_id, project_id, resource_id, 1 AS upload_type_id, 1 AS upload_status_id,
               CASE WHEN rf = 'A' THEN '/up/' ELSE '' END || 'file' || CAST(resource_id AS STRING) AS parameter,
               d - INTERVAL '20' DAY AS create_date, d - INTERVAL '10' DAY AS modify_date, 'user' AS modify_user
        FROM src_entry WHERE q > 5""",
    "src_submission": """
        SELECT resource_id + 500000 AS submission_id, resource_id AS upload_id, project_id AS entry_project_id, CASE WHEN ln = 7 THEN 3 ELSE 1 END AS submission_type_id,
               CASE WHEN q > 45 THEN 5 WHEN q > 38 THEN 7 WHEN q > 34 THEN 2 WHEN q > 30 THEN 3 WHEN q > 22 THEN 4 ELSE 1 END AS submission_status_id,
               ln AS placement, price / 1000 AS initial_score, CASE WHEN ln = 1 THEN 100 ELSE price / 900 END AS final_score,
               CASE WHEN ln <= 3 THEN project_id * 10 + ln END AS prize_id,
               CASE WHEN tax > 0.06 THEN TRUE WHEN tax > 0.02 THEN FALSE END AS mark_for_purchase,
               d - INTERVAL '19' DAY AS create_date, d - INTERVAL '5' DAY AS modify_date, 'user' AS modify_user
        FROM src_entry WHERE q > 5""",
    "src_prize": """
        SELECT project_id * 10 + place AS prize_id, project_id, CASE WHEN place = 4 THEN 14 ELSE 15 END AS prize_type_id, place,
               CAST(floor(o_totalprice / (100 * place)) AS DECIMAL(10,2)) AS prize_amount, CASE WHEN place = 4 THEN 5 ELSE 1 END AS number_of_submissions
        FROM (SELECT o_orderkey AS project_id, o_totalprice, EACH(1, 2, 3, 4) AS place FROM orders) x WHERE o_totalprice > 60000 * place""",
    "src_review": f"""
        SELECT submission_id * 10 + role AS review_id, submission_id, {_STAFF} + entry_project_id * 20 + role AS resource_id, entry_project_id,
               role AS scorecard_id, CAST(floor(final_score - role) AS DECIMAL(10,2)) AS score, CAST(floor(initial_score - role) AS DECIMAL(10,2)) AS initial_score,
               CASE WHEN submission_status_id = 2 THEN 0 ELSE 1 END AS committed, modify_date, modify_user, placement
        FROM (SELECT submission_id, entry_project_id, final_score, initial_score, submission_status_id, modify_date, modify_user, placement, EACH(2, 4, 6) AS role FROM src_submission) x""",
    "src_review_item": """
        SELECT review_id * 10 + 1 AS review_item_id, review_id, (review_id * 7) % 1000 AS scorecard_question_id,
               CASE placement WHEN 1 THEN '3' WHEN 2 THEN '7/9' WHEN 3 THEN 'Yes' WHEN 4 THEN '2/4' WHEN 5 THEN '' WHEN 6 THEN '9/10' ELSE 'x/y' END AS answer,
               modify_date - INTERVAL '3' DAY AS modify_date, modify_user, placement
        FROM src_review WHERE score > 30""",
    "src_review_item_comment": """
        SELECT review_item_id * 10 + kind AS review_item_comment_id, review_item_id, kind AS comment_type_id,
               CASE WHEN placement = 3 AND kind = 5 THEN NULL ELSE 'comment ' || CAST(placement AS STRING) END AS content,
               CASE WHEN kind = 4 THEN CASE placement WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Failed' WHEN 3 THEN 'Succeeded' END
                    WHEN kind = 5 THEN CASE placement WHEN 1 THEN '2/4' WHEN 2 THEN '5/9' WHEN 4 THEN '1' END END AS extra_info,
               modify_date + INTERVAL '1' DAY * kind AS modify_date, modify_user
        FROM (SELECT review_item_id, placement, modify_date, modify_user, EACH(1, 2, 3, 4, 5) AS kind FROM src_review_item) x
        WHERE NOT (placement > 4 AND kind > 3) AND NOT (placement = 2 AND kind = 5)""",
    "src_comment_type_lu": "SELECT EACH(1, 2, 3, 4, 5) AS comment_type_id, 'comment type' AS name FROM region WHERE r_regionkey = 0",
    "src_scorecard_question": """
        SELECT doc_id AS scorecard_question_id, n_chars % 10 AS scorecard_section_id, doc_id % 5 AS scorecard_question_type_id,
               text AS description, ' ' || source AS guideline, CAST(n_chars % 90 + 10 AS DOUBLE) AS weight, n_chars % 7 AS sort,
               o_orderdate AS modify_date, CASE WHEN lang = 'en' THEN 'Converter' ELSE 'user' END AS modify_user
        FROM documents JOIN orders ON o_orderkey = doc_id""",
    "src_scorecard_section": """
        SELECT s_suppkey AS scorecard_section_id, s_nationkey AS scorecard_group_id, s_name AS name, CAST(s_suppkey + 40 AS DOUBLE) AS weight,
               s_suppkey % 5 AS sort, o_orderdate AS modify_date, 'Converter' AS modify_user
        FROM supplier JOIN orders ON o_orderkey = s_suppkey""",
    "src_scorecard_group": """
        SELECT n_nationkey AS scorecard_group_id, n_regionkey AS scorecard_id, n_name AS name, CAST(n_nationkey + 50 AS DOUBLE) AS weight,
               n_nationkey % 4 AS sort, o_orderdate AS modify_date, 'Converter' AS modify_user
        FROM nation JOIN orders ON o_orderkey = n_nationkey""",
    "src_scorecard": """
        SELECT o_orderkey AS scorecard_id, CASE WHEN o_orderkey < 10 THEN CASE WHEN o_orderkey IN (2, 6) THEN 2 ELSE 1 END ELSE o_custkey % 5 END AS scorecard_type_id,
               o_orderdate AS modify_date, CASE WHEN o_orderpriority = '5-LOW' THEN 'Converter' ELSE 'user' END AS modify_user FROM orders""",
    "src_scorecard_type_lu": """
        SELECT r_regionkey AS scorecard_type_id, r_name AS name, o_orderdate AS modify_date, 'Converter' AS modify_user
        FROM region JOIN orders ON o_orderkey = r_regionkey""",
    "src_payment": "SELECT o_orderkey AS payment_id, o_orderkey * 10 + 1 AS most_recent_detail_id, o_orderdate - INTERVAL '5' DAY AS create_date, o_orderdate AS modify_date FROM orders",
    "src_payment_detail": """
        SELECT o_orderkey * 10 + k AS payment_detail_id, o_orderkey AS payment_id_of, o_custkey AS user_id, CAST(floor(o_totalprice * 0.8) AS DECIMAL(12,2)) AS net_amount,
               CAST(o_totalprice AS DECIMAL(12,2)) AS gross_amount, CAST(floor(o_totalprice * (1 - 0.1 * k)) AS DECIMAL(12,2)) AS total_amount, 'payment of ' || o_orderpriority AS payment_desc,
               CASE o_custkey % 6 WHEN 0 THEN 6 WHEN 1 THEN 24 WHEN 2 THEN 7 WHEN 3 THEN 45 WHEN 4 THEN 13 ELSE 1 END AS payment_type_id,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 69 WHEN o_orderpriority = '5-LOW' THEN 65 WHEN o_orderstatus = 'O' THEN 55 ELSE 53 END AS payment_status_id,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS date_due, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS date_paid,
               o_orderdate + INTERVAL '1' HOUR * (o_custkey % 20) AS date_modified, o_orderdate + INTERVAL '1' MINUTE * (o_custkey % 60) AS create_date,
               CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS algorithm_round_id, o_custkey + 11 AS algorithm_problem_id, o_custkey + 12 AS component_contest_id,
               CASE WHEN o_custkey % 3 > 0 THEN o_orderkey - o_orderkey % 3 END AS component_project_id,
               o_custkey + 13 AS studio_contest_id, 0 AS digital_run_stage_id, o_custkey + 15 AS digital_run_season_id, o_custkey + 16 AS digital_run_track_id,
               CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey - 1 END AS parent_payment_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS installment_number,
               o_custkey % 2 AS charity_ind, CASE WHEN o_orderstatus = 'F' THEN 'client ' || CAST(o_custkey % 9 AS STRING) END AS client,
               CASE WHEN o_orderstatus = 'O' THEN 'J-' || CAST(o_custkey AS STRING) END AS jira_issue_id
        FROM (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority, EACH(0, 1) AS k FROM orders) x""",
    "src_payment_detail_xref": "SELECT payment_id_of AS payment_id, payment_detail_id FROM src_payment_detail",
    "src_payment_type_lu": """
        SELECT payment_type_id, 'type ' || CAST(payment_type_id AS STRING) AS payment_type_desc,
               CASE payment_type_id WHEN 6 THEN 2 WHEN 24 THEN 2 WHEN 7 THEN 1 WHEN 45 THEN 6 WHEN 13 THEN 8 ELSE 5 END AS payment_reference_id,
               1 AS show_in_profile_ind, payment_type_id % 2 AS show_details_ind, o_orderdate AS create_date, o_orderdate AS modify_date
        FROM (SELECT EACH(1, 6, 7, 13, 24, 45) AS payment_type_id FROM region WHERE r_regionkey = 0) x JOIN orders ON o_orderkey = payment_type_id""",
    "src_payment_status_lu": "SELECT payment_status_id, 'status ' || CAST(payment_status_id AS STRING) AS payment_status_desc FROM (SELECT EACH(53, 55, 65, 68, 69) AS payment_status_id FROM region WHERE r_regionkey = 0) x",
    "src_contest": """
        SELECT s_suppkey AS contest_id, s_name AS contest_name, o_orderdate AS start_date, o_orderdate + INTERVAL '90' DAY AS end_date, s_nationkey % 5 AS contest_type_id,
               112 + s_nationkey % 2 AS phase_id, s_nationkey AS event_id, CASE s_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 39 END AS project_category_id,
               s_nationkey % 2 AS contest_result_calculator_id, o_orderdate AS modify_date
        FROM supplier JOIN orders ON o_orderkey = s_suppkey""",
    "src_contest_type_lu": "SELECT r_regionkey AS contest_type_id, r_name AS contest_type_desc FROM region",
    "src_contest_prize": """
        SELECT s_suppkey * 10 + place AS contest_prize_id, s_suppkey AS contest_id, place AS prize_type_id, place, CAST(floor(s_acctbal / place) AS DECIMAL(10,2)) AS prize_amount,
               'prize ' || CAST(place AS STRING) AS prize_desc, o_orderdate AS modify_date
        FROM (SELECT s_suppkey, s_acctbal, EACH(1, 2, 3) AS place FROM supplier) x JOIN orders ON o_orderkey = s_suppkey""",
    "src_prize_type_lu": "SELECT n_nationkey AS prize_type_id, n_name AS prize_type_desc FROM nation",
    "src_user_contest_prize": "SELECT c_custkey AS user_id, (c_nationkey % 10) * 10 + 1 + c_custkey % 3 AS contest_prize_id, CAST(c_acctbal AS DECIMAL(10,2)) AS payment FROM customer",
    "src_contest_project_xref": "SELECT o_custkey % 10 AS contest_id, o_orderkey AS project_id, o_orderdate + INTERVAL '3' DAY AS create_date FROM orders WHERE o_totalprice > 100000",
    "src_contest_stage_xref": "SELECT s_suppkey AS contest_id, s_suppkey AS stage_id, 1.0 + s_nationkey % 2 AS top_performers_factor FROM supplier",
    "src_contest_result_calculator_lu": "SELECT id AS contest_result_calculator_id, CASE id WHEN 0 THEN 'points' ELSE 'top_performers' END AS class_name FROM (SELECT EACH(0, 1) AS id FROM region WHERE r_regionkey = 0) x",
    "src_event": "SELECT s_suppkey AS event_id, s_name AS event_desc, o_orderdate AS modify_date FROM supplier JOIN orders ON o_orderkey = s_suppkey",
    "src_event_registration": """
        SELECT CAST(floor(value) AS BIGINT) AS event_id, user_id, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS eligible_ind, max(props) AS notes,
               min(ts) AS create_date, max(ts) AS modify_date FROM events GROUP BY floor(value), user_id""",
    "src_user_event_xref": "SELECT CAST(floor(value) AS BIGINT) AS event_id, user_id, min(ts) AS create_date, max(ts) AS modify_date FROM events WHERE event_type <> 'view' GROUP BY floor(value), user_id",
    "src_dr_points": """
        SELECT event_id AS dr_points_id, user_id % 10 AS track_id, CASE event_type WHEN 'purchase' THEN 2 ELSE 1 END AS dr_points_reference_type_id,
               CASE event_type WHEN 'purchase' THEN 2 ELSE 1 END AS dr_points_operation_id, 1 AS dr_points_type_id, 1 AS dr_points_status_id, event_type AS dr_points_desc,
               user_id, CAST(value AS DECIMAL(10,2)) AS amount, ts AS application_date, ts AS award_date,
               CASE event_type WHEN 'purchase' THEN event_id - 1 ELSE event_id END AS reference_id, event_type = 'view' AS is_potential, ts AS create_date,
               CASE WHEN event_type <> 'error' THEN ts END AS modify_date
        FROM events""",
    "src_dr_points_lu": "SELECT EACH(1, 2) AS id, 'points' AS descr FROM region WHERE r_regionkey = 0",
    "src_dr_points_status_lu": "SELECT id AS dr_points_status_id, descr || ' status' AS dr_points_status_desc FROM src_dr_points_lu",
    "src_dr_points_type_lu": "SELECT id AS dr_points_type_id, descr || ' type' AS dr_points_type_desc FROM src_dr_points_lu",
    "src_dr_points_operation_lu": "SELECT id AS dr_points_operation_id, descr || ' operation' AS dr_points_operation_desc FROM src_dr_points_lu",
    "src_dr_points_reference_type_lu": "SELECT id AS dr_points_reference_type_id, descr || ' reference' AS dr_points_reference_type_desc FROM src_dr_points_lu",
    "src_track": """
        SELECT s_suppkey AS track_id, s_nationkey % 5 AS track_type_id, s_nationkey % 5 AS track_status_id, s_name AS track_desc,
               o_orderdate AS track_start_date, o_orderdate + INTERVAL '300' DAY AS track_end_date, o_orderdate AS create_date, s_nationkey % 2 AS points_calculator_id
        FROM supplier JOIN orders ON o_orderkey = s_suppkey""",
    "src_track_project_category_xref": "SELECT s_suppkey AS track_id, CASE s_nationkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 38 ELSE 39 END AS project_category_id FROM supplier",
    "src_points_calculator_lu": "SELECT id AS points_calculator_id, CASE id WHEN 0 THEN 'placement' ELSE 'winner_takes_all' END AS class_name FROM (SELECT EACH(0, 1) AS id FROM region WHERE r_regionkey = 0) x",
    "src_track_status_lu": "SELECT r_regionkey AS track_status_id, r_name AS track_status_desc FROM region",
    "src_track_type_lu": "SELECT r_regionkey AS track_type_id, r_name AS track_type_desc FROM region",
    "src_track_contest": """
        SELECT s_suppkey AS track_contest_id, s_suppkey % 10 AS track_id, s_name AS track_contest_desc, s_nationkey % 5 AS track_contest_type_id,
               s_nationkey % 2 AS track_contest_result_calculator_id, o_orderdate AS create_date
        FROM supplier JOIN orders ON o_orderkey = s_suppkey""",
    "src_track_contest_type_lu": "SELECT r_regionkey AS track_contest_type_id, r_name AS track_contest_type_desc FROM region",
    "src_track_contest_result_calculator_lu": "SELECT id AS track_contest_result_calculator_id, CASE id WHEN 0 THEN 'points' ELSE 'top_performers' END AS class_name FROM (SELECT EACH(0, 1) AS id FROM region WHERE r_regionkey = 0) x",
    "src_user": """
        SELECT c_custkey AS user_id, c_name AS handle, lower(c_name) AS handle_lower, 'first' AS first_name, c_mktsegment AS last_name, CAST(NULL AS STRING) AS middle_name,
               'code' AS activation_code, CASE WHEN c_acctbal < 0 THEN 'I' ELSE 'A' END AS status, hi AS last_site_hit_date, 'web' AS reg_source, 'a' AS utm_source,
               'b' AS utm_medium, 'c' AS utm_campaign, lo AS create_date, lo + INTERVAL '20' DAY AS modify_date, hi AS last_login
        FROM customer JOIN (SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "src_coder": """
        SELECT user_id AS coder_id, create_date AS member_since, 'quote' AS quote, 1 AS language_id, CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END AS coder_type_id,
               CASE WHEN c_nationkey > 2 THEN ' ' || CAST(c_nationkey AS STRING) END AS comp_country_code, modify_date
        FROM src_user JOIN customer ON c_custkey = user_id""",
    "src_email": "SELECT c_custkey AS user_id, c_name || '@x' AS address, CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS primary_ind, u.modify_date FROM customer JOIN src_user u ON user_id = c_custkey",
    "src_address": """
        SELECT c_custkey * 10 + 2 AS address_id, CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 2 END AS address_type_id, CASE WHEN c_nationkey > 10 THEN 'ST' END AS state_code,
               CASE WHEN c_nationkey > 5 THEN CAST(c_nationkey AS STRING) END AS country_code, 'street' AS address1, CAST(NULL AS STRING) AS address2, n_name AS city, '123' AS zip,
               last_login AS modify_date
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN src_user ON user_id = c_custkey""",
    "src_user_address_xref": "SELECT c_custkey AS user_id, c_custkey * 10 + 2 AS address_id FROM customer WHERE c_acctbal > 100",
    "src_phone": """
        SELECT user_id, 'p' || CAST(kind AS STRING) AS phone_number, kind AS phone_type_id, 1 AS primary_ind, create_date AS modify_date
        FROM (SELECT user_id, create_date, last_name, EACH(1, 2) AS kind FROM src_user) x WHERE NOT (kind = 2 AND last_name = 'MACHINERY')""",
    "src_image": "SELECT c_custkey AS image_id, CASE WHEN c_acctbal > 1000 THEN 1 ELSE 2 END AS image_type_id, create_date AS modify_date FROM customer JOIN src_user ON user_id = c_custkey",
    "src_coder_image_xref": "SELECT c_custkey AS coder_id, c_custkey AS image_id, CASE WHEN c_acctbal > 3000 THEN 1 ELSE 0 END AS display_flag FROM customer",
    "src_client": "SELECT s_suppkey AS client_id, s_name AS name, o_orderdate - INTERVAL '9' DAY AS creation_date, o_orderdate AS modification_date, 'cmc' AS cmc_account_id, 'cn' AS customer_number FROM supplier JOIN orders ON o_orderkey = s_suppkey",
    "src_billing_project": """
        SELECT c_custkey AS project_id, c_name AS name, create_date AS creation_date, create_date AS modification_date, 'po' AS po_box_number, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS active,
               create_date AS start_date, last_login AS end_date FROM customer JOIN src_user ON user_id = c_custkey""",
    "src_client_project": "SELECT c_custkey AS project_id, c_nationkey % 10 AS client_id, last_login AS modification_date FROM customer JOIN src_user ON user_id = c_custkey",
    "src_tc_direct_project": "SELECT c_custkey AS project_id, c_name AS name, c_mktsegment AS description, c_nationkey AS project_status_id, create_date, last_login AS modify_date FROM customer JOIN src_user ON user_id = c_custkey",
    "src_direct_project_account": "SELECT o_custkey AS project_id, o_orderkey AS billing_account_id FROM orders WHERE o_orderstatus = 'F'",
    "src_evaluation": "SELECT p_partkey AS evaluation_id, p_name AS evaluation_name, CAST(p_size AS DOUBLE) AS value, p_size % 7 AS evaluation_type_id FROM part",
    "src_evaluation_type": "SELECT r_regionkey AS evaluation_type_id, r_name AS eval_type_name FROM region",
    "src_round": "SELECT p_partkey AS round_id, CASE p_size % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 10 WHEN 3 THEN 13 WHEN 4 THEN 15 ELSE 99 END AS round_type_id FROM part",
    "src_round_segment": """
        SELECT round_id, segment_id, o_orderdate + INTERVAL '1' HOUR * (segment_id * 30) AS start_time, o_orderdate + INTERVAL '1' HOUR * (segment_id * 30 + 20) AS end_time
        FROM (SELECT p_partkey AS round_id, o_orderdate, EACH(1, 2, 4) AS segment_id FROM part JOIN orders ON o_orderkey = p_partkey) x""",
    "src_room_result": "SELECT l_partkey AS round_id, l_suppkey AS coder_id, CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS attended, CASE WHEN l_quantity > 10 THEN l_linenumber END AS room_seed FROM lineitem",
    "src_long_comp_result": "SELECT l_partkey AS round_id, l_suppkey AS coder_id, CASE WHEN l_returnflag = 'A' THEN 'N' ELSE 'Y' END AS attended FROM lineitem",
    "src_round_registration": "SELECT l_partkey AS round_id, l_suppkey AS coder_id FROM lineitem WHERE l_quantity > 20",
    "src_long_component_state": "SELECT o_orderkey AS long_component_state_id, o_custkey AS round_id FROM orders",
    "src_long_submission": "SELECT l_orderkey AS long_component_state_id, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS example FROM lineitem",
    "src_project_result": """
        SELECT project_id, user_id, CASE WHEN q > 10 THEN 1 ELSE 0 END AS valid_submission_ind, CAST(floor(price / 700) AS DECIMAL(10,2)) AS raw_score,
               CASE WHEN q > 8 THEN CAST(floor(price / 720) AS DECIMAL(10,2)) END AS final_score, CASE WHEN ln <= 2 THEN CAST(floor(price / 10) AS DECIMAL(10,2)) END AS payment,
               CASE WHEN disc > 0.02 THEN CAST(floor(price / 50) AS BIGINT) END AS old_rating, CASE WHEN disc > 0.01 THEN CAST(floor(price / 48) AS BIGINT) END AS new_rating,
               CASE WHEN q > 12 THEN ln END AS placed, CASE WHEN disc > 0.03 THEN 1 ELSE 0 END AS rating_ind, CASE WHEN q > 20 THEN 1 ELSE 0 END AS passed_review_ind,
               ln - 2 AS point_adjustment, project_id * 10 + ln AS rating_order, d - INTERVAL '30' DAY AS create_date, d - INTERVAL '4' DAY AS modify_date
        FROM src_entry""",
    "src_project_reliability": "SELECT project_id, user_id, CAST(disc AS DECIMAL(5,4)) AS reliability_before_resolution, CAST(tax AS DECIMAL(5,4)) AS reliability_after_resolution, 1 AS reliable_ind FROM src_entry WHERE rf <> 'N'",
    "src_component_inquiry": "SELECT l_orderkey AS project_id, l_suppkey AS user_id, l_shipdate AS create_time FROM lineitem WHERE l_returnflag = 'A'",
    "src_royalty": "SELECT l_suppkey AS user_id, l_shipdate AS royalty_date, max(CAST(floor(l_extendedprice / 100) AS DECIMAL(7,2))) AS amount, max(l_returnflag) AS description, max(l_shipdate) + INTERVAL '9' DAY AS modify_date FROM lineitem GROUP BY l_suppkey, l_shipdate",
    "src_season": "SELECT s_suppkey AS season_id, s_name AS name, s_nationkey % 2 AS rookie_competition_ind, s_suppkey + 1 AS next_rookie_season_id, o_orderdate AS modify_date FROM supplier JOIN orders ON o_orderkey = s_suppkey",
    "src_stage": "SELECT c_custkey AS stage_id, c_nationkey AS season_id, c_name AS name, create_date AS start_date, create_date + INTERVAL '30' DAY AS end_date, last_login AS modify_date FROM customer JOIN src_user ON user_id = c_custkey",
    "src_linked_project_xref": "SELECT o_orderkey AS source_project_id, o_orderkey + 1 AS dest_project_id, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 3 END AS link_type_id FROM orders",
    "src_user_rating": """
        SELECT user_id, phase_id, max(rating) AS rating, max(project_id) AS last_rated_project_id, count(*) AS num_ratings, 300 AS vol, 1200 AS rating_no_vol, max(modify_date) AS mod_date_time
        FROM (SELECT r.user_id, p.project_category_id + 111 AS phase_id, coalesce(r.new_rating, 0) % 2500 AS rating, r.project_id, r.modify_date
              FROM src_project_result r JOIN src_project p ON p.project_id = r.project_id WHERE r.rating_ind = 1) x GROUP BY user_id, phase_id""",
    "src_user_reliability": "SELECT user_id, phase_id, CAST(rating AS DOUBLE) / 4096 AS rating, mod_date_time AS modify_date FROM src_user_rating",
    "src_current_school": "SELECT c_custkey AS coder_id, c_nationkey % 12 AS school_id FROM customer WHERE c_acctbal > 200",
    "src_projects": """
        SELECT o_orderkey AS id, o_custkey AS directProjectId, o_custkey % 9 AS billingAccountId, o_orderpriority AS name, '{{}}' AS external, 'text' AS description, '[]' AS bookmarks,
               '{{}}' AS utm, CAST(o_totalprice AS DECIMAL(10,2)) AS estimatedPrice, CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS actualPrice, 'terms' AS terms,
               'app' AS type, o_orderstatus AS status, '{{}}' AS details, 'all' AS challengeEligibility, CAST(NULL AS STRING) AS cancelReason, CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS deletedAt,
               o_orderdate AS createdAt, o_orderdate AS updatedAt, o_custkey AS createdBy, o_custkey AS updatedBy FROM orders""".replace("{{", "{").replace("}}", "}"),
    "src_project_members": "SELECT resource_id AS id, user_id AS userId, CASE WHEN rf = 'A' THEN 'manager' ELSE 'member' END AS role, rf = 'A' AS isPrimary, CASE WHEN rf = 'R' THEN d END AS deletedAt, d AS createdAt, d AS updatedAt, user_id AS createdBy, user_id AS updatedBy FROM src_entry",
    # warehouse tables that other loads read
    "dw_calendar": """
        SELECT CAST(EXTRACT(YEAR FROM day) * 10000 + EXTRACT(MONTH FROM day) * 100 + EXTRACT(DAY FROM day) AS BIGINT) AS calendar_id, CAST(EXTRACT(YEAR FROM day) AS INT) AS year,
               CAST(EXTRACT(MONTH FROM day) AS INT) AS month_numeric, CAST(EXTRACT(DAY FROM day) AS INT) AS day_of_month, day AS date
        FROM (SELECT o_orderdate AS day FROM orders UNION SELECT l_shipdate FROM lineitem UNION SELECT end_date FROM src_stage) x""",
    "dw_time": "SELECT EACH(0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23) AS hour_24, minute FROM (SELECT DISTINCT CAST(o_custkey % 60 AS INT) AS minute FROM orders) x",
    "dw_project": """
        SELECT p.project_id, p.project_category_id, p.project_category_id + 111 AS phase_id, 'Application' AS category_desc, p.project_status_id AS status_id, p.tc_direct_project_id,
               c.end_date AS complete_date, CASE WHEN p.project_status_id <> 1 THEN p.modify_date + INTERVAL '35' DAY END AS rating_date,
               p.create_date AS posting_date, CAST(p.project_id % 40 AS DECIMAL(10,2)) AS admin_fee, CAST(p.project_id % 900 AS DECIMAL(10,2)) AS contest_prizes_total
        FROM src_project p LEFT JOIN (SELECT project_id, max(actual_end_time) AS end_date FROM src_project_phase WHERE phase_type_id = 4 GROUP BY project_id) c ON c.project_id = p.project_id""",
    "dw_project_result": """
        SELECT project_id, user_id, valid_submission_ind, rating_ind, placed, new_rating, final_score, payment, rating_order FROM src_project_result""",
    "dw_submission_review": """
        SELECT entry_project_id AS project_id, CAST(floor(submission_id / 1) AS BIGINT) % 1000000 - 500000 AS user_id, review_id,
               placement AS num_appeals, CASE WHEN placement > 3 THEN NULL ELSE placement - 1 END AS num_successful_appeals FROM src_review""",
    "dw_user_rating": "SELECT user_id, phase_id, rating, last_rated_project_id FROM src_user_rating",
    "dw_dr_points": "SELECT dr_points_id, track_id, dr_points_reference_type_id, user_id, amount, reference_id, is_potential FROM src_dr_points",
    "dw_submission": """
        SELECT resource_id + 500000 AS submission_id, user_id AS submitter_id, project_id, 'old' AS submission_url, 1 AS submission_type
        FROM src_entry WHERE q > 25 AND ln < 7""",
    "dw_coder": "SELECT coder_id, status, coder_type_id, comp_country_code FROM src_coder JOIN src_user ON user_id = coder_id",
    "dw_stage": """
        SELECT s.stage_id, a.calendar_id AS start_calendar_id, b.calendar_id AS end_calendar_id
        FROM (SELECT year * 10 + q AS stage_id, min(day) AS lo, max(day) AS hi
              FROM (SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS BIGINT) AS year, CAST(EXTRACT(QUARTER FROM o_orderdate) AS BIGINT) AS q, o_orderdate AS day FROM orders) x
              GROUP BY year, q) s
        JOIN dw_calendar a ON a.date = s.lo JOIN dw_calendar b ON b.date = s.hi""",
}
TABLES["dw_time"] = "SELECT hour_24 * 60 + minute AS time_id, hour_24, minute FROM (" + TABLES["dw_time"] + ") y"

# Attributes side by side, for the SQL of the loads.
TABLES["src_attributes"] = (
    "SELECT project_id, "
    + ", ".join(
        f"max(CASE WHEN project_info_type_id = {n} THEN value END) AS v{n}" for n in sorted(fixed.PROJECT_ATTRIBUTES.values())
    )
    + " FROM src_project_info GROUP BY project_id"
)

_NAME = re.compile(r"\b(?:src|dw)_[a-z_]+\b")
_EACH = re.compile(r"EACH\(([^)]*)\)")


def needed(sql: str, views: dict[str, str] | None = None) -> list[str]:
    """World tables a query reads, directly or not, in an order that defines each before its use.

    Those that ``views`` has are not looked into.
    """
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in TABLES and name not in order:
                if name not in (views or {}):
                    visit(TABLES[name])
                order.append(name)

    visit(sql)
    return order


def _query(sql: str, each: str, kept: str = "", views: dict[str, str] | None = None) -> str:
    known = {name: f"SELECT * FROM {view}" for name, view in (views or {}).items()}
    tables = ",\n".join(f"{name} AS {kept}({known.get(name, TABLES[name])})" for name in needed(sql, views))
    if not tables:
        return sql
    body = sql.strip()
    joined = f"WITH {tables},\n{body[4:]}" if body[:5].upper() == "WITH " else f"WITH {tables}\n{body}"
    return _EACH.sub(each, joined)


def duck_sql(sql: str) -> str:
    # Without this DuckDB works each table out anew wherever it is named.
    return _query(sql, r"unnest([\1])", "MATERIALIZED ")


def spark_table(spark: SparkSession, folder: str, name: str, views: dict[str, str] | None = None) -> DataFrame:
    """One world table over the test tables of a folder.

    ``views`` holds the shared tables of one query, each settled when it is first needed.
    """
    tag = f"{zlib.crc32(folder.encode()):08x}"
    wanted = f"SELECT * FROM {name}"
    if views is not None:
        for shared in needed(wanted, views):
            if shared in SHARED and shared not in views:
                view = f"kept_{uuid4().hex}"
                with lasting():
                    settle(spark_table(spark, folder, shared)).createOrReplaceTempView(view)
                views[shared] = view
    sql = _query(wanted, r"explode(array(\1))", views=views)
    for base in BASE:
        if re.search(rf"\b{base}\b", sql):
            view = f"{base}_{tag}"
            if not spark.catalog.tableExists(view):
                spark.read.parquet(f"{folder}/{base}.parquet").createOrReplaceTempView(view)
            sql = re.sub(rf"\b{base}\b", view, sql)
    return spark.sql(sql)
