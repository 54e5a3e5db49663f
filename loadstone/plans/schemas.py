"""Columns of the warehouse tables."""

_MONEY = "decimal(10,2)"

SCHEMAS: dict[str, str] = {
    "update_log": "log_id bigint, calendar_id bigint, log_timestamp timestamp_ntz, log_type_id bigint",
    "calendar": "calendar_id bigint, year int, month_numeric int, month_alpha string, day_of_month int, day_of_week int, "
    "week_day string, year_month string, week_of_year int, day_of_year int, holiday string, weekend string, "
    "date timestamp_ntz, week_year int, quarter_of_year int",
    "time": "time_id bigint, minute int, hour int, hour_24 int, meridiem string, full_time string, time_12 string, time_24 string",
    "appeal": "appeal_id bigint, scorecard_question_id bigint, scorecard_id bigint, project_id bigint, user_id bigint, "
    "reviewer_id bigint, raw_evaluation_id bigint, final_evaluation_id bigint, appeal_text string, appeal_response string, "
    "successful_ind bigint",
    "client_project_dim": "client_project_id bigint, client_id bigint, client_name string, client_create_date timestamp_ntz, "
    "client_modification_date timestamp_ntz, billing_project_id bigint, project_name string, project_create_date timestamp_ntz, "
    "project_modification_date timestamp_ntz, billing_account_code string, cmc_account_id string, customer_number string, "
    "billing_account_status bigint, billing_account_start_date timestamp_ntz, billing_account_end_date timestamp_ntz",
    "coder": "coder_id bigint, state_code string, country_code string, first_name string, last_name string, home_phone string, "
    "work_phone string, address1 string, address2 string, city string, zip string, middle_name string, activation_code string, "
    "member_since timestamp_ntz, quote string, modify_date timestamp_ntz, language_id bigint, coder_type_id bigint, status string, "
    "email string, last_login timestamp_ntz, image bigint, comp_country_code string, last_site_hit_date timestamp_ntz, "
    "reg_source string, utm_source string, utm_medium string, utm_campaign string, create_date timestamp_ntz, handle string, "
    "handle_lower string",
    "contest": "contest_id bigint, contest_name string, contest_type_id bigint, contest_type_desc string, "
    "contest_start_timestamp timestamp_ntz, contest_end_timestamp timestamp_ntz, phase_id bigint, event_id bigint, "
    "project_category_id bigint, project_category_name string",
    "contest_prize": f"contest_prize_id bigint, contest_id bigint, prize_type_id bigint, prize_type_desc string, place bigint, "
    f"prize_amount {_MONEY}, prize_desc string",
    "contest_project_xref": "project_id bigint, contest_id bigint",
    "contest_result": "contest_id bigint, coder_id bigint, initial_points double, final_points double, potential_points double, "
    "current_place bigint, current_prize double",
    "country_user_rank": "user_id bigint, country_code string, rank bigint, rank_no_tie bigint, percentile decimal(7,4), "
    "user_rank_type_id bigint, phase_id bigint",
    "design_project_result": f"project_id bigint, user_id bigint, submission_id bigint, upload_id bigint, prize_id bigint, "
    f"prize_amount {_MONEY}, placement bigint, dr_points double, is_checkpoint bigint, client_selection bigint, "
    "submit_timestamp timestamp_ntz, review_complete_timestamp timestamp_ntz, inquire_timestamp timestamp_ntz, submit_ind bigint, "
    "valid_submission_ind bigint",
    "direct_project_dim": "direct_project_id bigint, name string, project_status_id bigint, project_create_date timestamp_ntz, "
    "project_modification_date timestamp_ntz, billing_project_id bigint, description string",
    "dr_points": f"dr_points_id bigint, track_id bigint, dr_points_reference_type_id bigint, dr_points_reference_type_desc string, "
    "dr_points_operation_id bigint, dr_points_operation_desc string, dr_points_type_id bigint, dr_points_type_desc string, "
    "dr_points_status_id bigint, dr_points_status_desc string, dr_points_desc string, user_id bigint, "
    f"amount {_MONEY}, application_date timestamp_ntz, award_date timestamp_ntz, reference_id bigint, is_potential boolean",
    "evaluation_lu": "evaluation_id bigint, evaluation_desc string, evaluation_value double, evaluation_type_id bigint, "
    "evaluation_type_desc string",
    "event": "event_id bigint, event_name string",
    "event_registration": "event_id bigint, user_id bigint, eligible_ind bigint, notes string, create_date timestamp_ntz, "
    "modify_date timestamp_ntz",
    "participation": "user_id bigint, participation_type bigint, participation_date timestamp_ntz",
    "payment": "payment_id bigint, payment_desc string, payment_type_id bigint, payment_type_desc string, reference_id bigint, "
    "parent_payment_id bigint, charity_ind bigint, show_in_profile_ind bigint, show_details_ind bigint, payment_status_id bigint, "
    "payment_status_desc string, client string, modified_calendar_id bigint, modified_time_id bigint, installment_number bigint, "
    "jira_ticket_id string, created_calendar_id bigint, created_time_id bigint",
    "user_payment": "payment_id bigint, user_id bigint, net_amount decimal(12,2), gross_amount decimal(12,2), due_calendar_id bigint, "
    "paid_calendar_id bigint, total_amount decimal(12,2)",
    "project": f"project_id bigint, component_id bigint, component_name string, num_registrations bigint, num_submissions bigint, "
    "num_valid_submissions bigint, avg_raw_score decimal(5,2), avg_final_score decimal(5,2), phase_id bigint, phase_desc string, "
    "category_id bigint, category_desc string, posting_date timestamp_ntz, submitby_date timestamp_ntz, complete_date timestamp_ntz, "
    "checkpoint_start_date timestamp_ntz, checkpoint_end_date timestamp_ntz, review_phase_id bigint, review_phase_name string, "
    "status_id bigint, status_desc string, level_id bigint, version_id bigint, version_text string, rating_date timestamp_ntz, "
    "viewable_category_ind bigint, num_submissions_passed_review bigint, winner_id bigint, stage_id bigint, digital_run_ind bigint, "
    "suspended_ind bigint, project_category_id bigint, project_category_name string, tc_direct_project_id bigint, "
    f"admin_fee {_MONEY}, first_place_prize {_MONEY}, num_checkpoint_submissions bigint, num_valid_checkpoint_submissions bigint, "
    f"total_prize {_MONEY}, contest_prizes_total {_MONEY}, client_project_id bigint, start_date_calendar_id bigint, "
    "duration decimal(10,2), fulfillment decimal(10,2), last_modification_date timestamp_ntz, challenge_manager bigint, "
    "challenge_creator bigint, challenge_launcher bigint, copilot bigint, registration_end_date timestamp_ntz, "
    f"scheduled_end_date timestamp_ntz, checkpoint_prize_amount {_MONEY}, checkpoint_prize_number bigint, dr_points {_MONEY}, "
    f"reliability_cost {_MONEY}, review_cost {_MONEY}, forum_id bigint, submission_viewable bigint, is_private bigint, "
    f"actual_total_prize {_MONEY}, copilot_cost {_MONEY}, estimated_reliability_cost {_MONEY}, estimated_review_cost {_MONEY}, "
    f"estimated_copilot_cost {_MONEY}, estimated_admin_fee {_MONEY}, task_ind bigint",
    "project_review": f"project_id bigint, reviewer_id bigint, total_payment {_MONEY}",
    "result_points": f"dr_points_id bigint, track_id bigint, user_id bigint, amount {_MONEY}, application_date timestamp_ntz, "
    "award_date timestamp_ntz, reference_id bigint, is_potential boolean",
    "project_platform": "project_id bigint, project_platform_id bigint, name string",
    "project_technology": "project_id bigint, project_technology_id bigint, name string",
    "project_result": f"project_id bigint, user_id bigint, submit_ind bigint, valid_submission_ind bigint, raw_score decimal(5,2), "
    "final_score decimal(5,2), inquire_timestamp timestamp_ntz, submit_timestamp timestamp_ntz, "
    f"review_complete_timestamp timestamp_ntz, payment {_MONEY}, old_rating bigint, new_rating bigint, old_reliability decimal(5,4), "
    "new_reliability decimal(5,4), placed bigint, rating_ind bigint, passed_review_ind bigint, points_awarded double, "
    "final_points double, potential_points double, reliable_submission_ind bigint, num_appeals bigint, "
    "num_successful_appeals bigint, old_rating_id bigint, new_rating_id bigint, num_ratings bigint, rating_order bigint",
    "project_spec_review_xref": "project_id bigint, spec_review_project_id bigint",
    "royalty": "user_id bigint, amount decimal(7,2), royalty_date timestamp_ntz, description string",
    "school_user_rank": "user_id bigint, school_id bigint, rank bigint, rank_no_tie bigint, percentile decimal(7,4), "
    "user_rank_type_id bigint, phase_id bigint",
    "scorecard_question": "scorecard_question_id bigint, scorecard_template_id bigint, question_text string, question_weight double, "
    "section_id bigint, section_desc string, section_weight double, section_group_id bigint, section_group_desc string, "
    "question_desc string, sort bigint, question_header string",
    "scorecard_response": "scorecard_question_id bigint, scorecard_id bigint, user_id bigint, reviewer_id bigint, project_id bigint, "
    "evaluation_id bigint",
    "scorecard_template": "scorecard_template_id bigint, scorecard_type_id bigint, scorecard_type_desc string",
    "season": "season_id bigint, start_calendar_id bigint, end_calendar_id bigint, name string, rookie_competition_ind bigint, "
    "next_rookie_season_id bigint",
    "stage": "stage_id bigint, season_id bigint, start_calendar_id bigint, end_calendar_id bigint, name string",
    "streak": "coder_id bigint, streak_type_id bigint, phase_id bigint, start_project_id bigint, end_project_id bigint, "
    "length bigint, is_current bigint",
    "subjective_response": "scorecard_question_id bigint, scorecard_id bigint, user_id bigint, reviewer_id bigint, project_id bigint, "
    "response_text string, response_type_id bigint, response_type_desc string, sort bigint",
    "submission": "submission_id bigint, submitter_id bigint, project_id bigint, submission_url string, submission_type bigint",
    "submission_review": "project_id bigint, user_id bigint, reviewer_id bigint, num_appeals bigint, num_successful_appeals bigint, "
    "final_score decimal(5,2), raw_score decimal(5,2), review_resp_id bigint, scorecard_id bigint, scorecard_template_id bigint",
    "submission_screening": "project_id bigint, user_id bigint, reviewer_id bigint, final_score decimal(5,2), scorecard_id bigint, "
    "scorecard_template_id bigint",
    "tcd_project_stat": f"direct_project_id bigint, project_category_id bigint, stat_date timestamp_ntz, cost {_MONEY}, "
    "duration decimal(10,2), fulfillment decimal(10,2), total_project bigint, create_user string, create_date timestamp_ntz, "
    "modify_user string, modify_date timestamp_ntz",
    "testcase_appeal": "appeal_id bigint, scorecard_question_id bigint, scorecard_id bigint, project_id bigint, user_id bigint, "
    "reviewer_id bigint, raw_num_passed bigint, raw_num_tests bigint, final_num_passed bigint, final_num_tests bigint, "
    "appeal_text string, appeal_response string, successful_ind bigint",
    "testcase_response": "scorecard_question_id bigint, scorecard_id bigint, user_id bigint, reviewer_id bigint, project_id bigint, "
    "num_tests bigint, num_passed bigint",
    "track": "track_id bigint, track_type_id bigint, track_type_desc string, track_status_id bigint, track_status_desc string, "
    "track_desc string, track_start_date timestamp_ntz, track_end_date timestamp_ntz",
    "track_contest": "track_contest_id bigint, track_id bigint, track_contest_desc string, track_contest_type_id bigint, "
    "track_contest_type_desc string",
    "track_contest_results": "track_contest_id bigint, user_id bigint, track_contest_placement bigint, "
    "track_contest_prize decimal(12,2), taxable_track_contest_prize decimal(12,2)",
    "user_contest_prize": f"user_id bigint, contest_id bigint, prize_type_id bigint, place bigint, prize_description string, "
    f"prize_amount {_MONEY}, prize_payment {_MONEY}",
    "user_event_xref": "user_id bigint, event_id bigint, create_date timestamp_ntz",
    "user_rank": "user_id bigint, phase_id bigint, rank bigint, percentile decimal(7,4), user_rank_type_id bigint",
    "user_rating": "user_id bigint, rating bigint, phase_id bigint, vol bigint, rating_no_vol bigint, num_ratings bigint, "
    "mod_date_time timestamp_ntz, create_date_time timestamp_ntz, last_rated_project_id bigint, highest_rating bigint, "
    "lowest_rating bigint",
    "user_reliability": "user_id bigint, rating decimal(5,4), phase_id bigint",
    "projects": f"id bigint, directProjectId bigint, billingAccountId bigint, name string, external string, bookmarks string, "
    f"utm string, estimatedPrice {_MONEY}, actualPrice {_MONEY}, type string, terms string, status string, details string, "
    "description string, challengeEligibility string, cancelReason string, deletedAt timestamp_ntz, createdAt timestamp_ntz, "
    "updatedAt timestamp_ntz, createdBy bigint, updatedBy bigint",
    "project_members": "id bigint, role string, userId bigint, isPrimary boolean, deletedAt timestamp_ntz, createdAt timestamp_ntz, "
    "updatedAt timestamp_ntz, createdBy bigint, updatedBy bigint",
}

# Large fact tables in buckets of their key, for ``Warehouse``: a load rewrites the buckets of the keys it touched.
BUCKETS: dict[str, tuple[list[str], int]] = {
    "appeal": (["appeal_id"], 64), "testcase_appeal": (["appeal_id"], 64),
    "testcase_response": (["scorecard_id"], 64), "scorecard_response": (["scorecard_id"], 64), "subjective_response": (["scorecard_id"], 64),
    "submission_review": (["project_id"], 64), "submission_screening": (["project_id"], 64), "project_result": (["project_id"], 64),
    "submission": (["submission_id"], 64), "payment": (["payment_id"], 64), "user_payment": (["payment_id"], 64),
    "dr_points": (["track_id"], 16), "contest_result": (["contest_id"], 64),
}
