"""Fixed values the loads must share with the systems they read from."""

# Project categories that are loaded.
LOAD_CATEGORIES = (
    1, 2, 5, 6, 7, 9, 13, 14, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 29,
    30, 31, 32, 34, 35, 36, 38, 39, 40,
)

# Categories that carry a rating; the phase id is category + 111.
RATED_CATEGORIES = (1, 2, 6, 7, 13, 14, 19, 23, 24, 26, 35, 36)
PHASE_OFFSET = 111

# Rank types.
RANK_OVERALL = 1
RANK_ACTIVE = 2

# Streak kinds and the phases they are kept for.
STREAK_WON = 1
STREAK_PAID = 2
STREAK_RATING_UP = 3
STREAK_RATING_DOWN = 4
STREAK_PHASES = (112, 113)

# Project states.
STATUS_DELETED = 3
STATUS_COMPLETED = 7
FEE_FREE_STATUSES = (4, 5, 6, 8, 11)

# Payment states that do not count as cost.
PAYMENT_EXCLUDED = (65, 68, 69)
PAYMENT_INACTIVE = (65, 69)
PAYMENT_DELETED = 69

# Payment types per cost column.
PRIZE_PAYMENTS = (6, 10, 13, 21, 29, 42, 43, 44, 49, 50, 51, 55, 60, 61, 64, 65)
RELIABILITY_PAYMENTS = (24,)
REVIEW_PAYMENTS = (7, 26, 28, 36)
COPILOT_PAYMENTS = (45, 57)

# Which id column a payment reference type points to.
PAYMENT_REFERENCES = {
    1: "algorithm_round_id",
    2: "component_project_id",
    3: "algorithm_problem_id",
    4: "studio_contest_id",
    5: "component_contest_id",
    6: "digital_run_stage_id",
    7: "digital_run_season_id",
    9: "digital_run_track_id",
}

# Share of the points per place (column) and number of placements (row).
PLACEMENT_SHARES = (
    (1.0, 0.0, 0.0, 0.0, 0.0),
    (0.7, 0.3, 0.0, 0.0, 0.0),
    (0.65, 0.25, 0.1, 0.0, 0.0),
    (0.6, 0.22, 0.1, 0.08, 0.0),
    (0.56, 0.2, 0.1, 0.08, 0.06),
)

# The mark that rows of an earlier migration carry, and the
# day before which a load still has to look for rows without it.
MIGRATION_USER = "Converter"
MIGRATION_CUTOVER = "2006-11-11 00:00:00"

# Time zone names in the source's date texts, hours from UTC.
ZONE_HOURS = {
    "UTC": 0.0, "GMT": 0.0, "Z": 0.0,
    "EST": -5.0, "EDT": -4.0, "CST": -6.0, "CDT": -5.0, "MST": -7.0, "MDT": -6.0, "PST": -8.0, "PDT": -7.0,
    "AKST": -9.0, "AKDT": -8.0, "HST": -10.0,
    "WET": 0.0, "WEST": 1.0, "BST": 1.0, "CET": 1.0, "CEST": 2.0, "EET": 2.0, "EEST": 3.0, "MSK": 3.0,
    "IST": 5.5, "SGT": 8.0, "HKT": 8.0, "JST": 9.0, "KST": 9.0, "AEST": 10.0, "AEDT": 11.0, "NZST": 12.0, "NZDT": 13.0,
}

# Run log type of the main load.
DEFAULT_LOG_TYPE = 8

# Attribute ids of a project.
PROJECT_ATTRIBUTES = {
    "version_ref": 1, "component_ref": 2, "forum": 4, "amount": 16, "complete_text": 21,
    "rating_text": 22, "winner": 23, "run_flag": 26, "run_points": 30, "admin_fee": 31,
    "billing": 32, "review_cost": 33, "review_cost_more": 35, "reliability_cost": 38,
    "reliability_flag": 45, "copilot_cost": 49, "viewable_flag": 53, "match_ref": 56,
    "fee_percentage": 57, "launcher": 58, "task_flag": 82,
}

# Tables that hold rows of a project, with the column that names it.
PROJECT_TABLES = (
    ("appeal", "project_id"), ("contest_project_xref", "project_id"), ("design_project_result", "project_id"),
    ("project", "project_id"), ("project_platform", "project_id"), ("project_result", "project_id"), ("project_review", "project_id"),
    ("project_spec_review_xref", "project_id"), ("project_technology", "project_id"), ("scorecard_response", "project_id"),
    ("streak", "end_project_id"), ("streak", "start_project_id"), ("subjective_response", "project_id"), ("submission", "project_id"),
    ("submission_review", "project_id"), ("submission_screening", "project_id"), ("testcase_appeal", "project_id"),
    ("testcase_response", "project_id"), ("user_rating", "last_rated_project_id"),
)
