"""Settings and the feature catalogue."""

from __future__ import annotations

import datetime as dt

# Defaults every operator takes as arguments.
COVID_RANGE = (dt.date(2020, 3, 1), dt.date(2021, 6, 30))
SEASON_START = (3, 1)
SEASON_END = (11, 15)
TARGET = "attendance"
TEST_FRACTION = 0.2
USABLE_SHARE = 0.80
MAX_MATCH_AGE_DAYS = 10
TREES = {"maxIter": 400, "maxDepth": 6, "stepSize": 0.05, "seed": 42}

# Field names searched for a gate figure.
GATE_FIELD_HINTS = ("attendance", "crowd", "spectators", "attendance_count")

# Payload fields a match record must carry.
REQUIRED_FIELDS = (
    "id", "season", "date_unix", "homeID", "awayID",
    "homeGoalCount", "awayGoalCount", "attendance",
)

# Raw table columns, and what each one is needed for.
RAW_COLUMNS = {
    "match_id": "key of the upsert",
    "season": "scope of the league table",
    "date": "order of standings and lags",
    "home_raw": "maps to a club",
    "away_raw": "maps to a club",
    "home_goals": "points and goal difference",
    "away_goals": "points and goal difference",
    "attendance": "the target",
}

# The feature families and the evidence class of each feature.
CALENDAR = ("day_of_week", "month", "is_weekend", "is_midweek")
LAGS = ("last_home_gate", "home_gate_ma3", "home_gate_ma5", "same_fixture_last_season")
CONTEXT = (
    "opponent_club_id", "is_derby", "matches_remaining", "is_season_opener", "is_final_home_match",
)
PROREL = (
    "rank_before", "opponent_rank_before", "rank_gap", "points_from_playoff_line",
    "is_mathematically_live", "matches_since_elimination", "points_from_relegation_line",
)
BASELINE = CALENDAR + LAGS + CONTEXT
MODELS = {"baseline": BASELINE, "prorel": BASELINE + PROREL}
EVIDENCE = {
    **dict.fromkeys(BASELINE + ("matches_since_elimination",), "measured"),
    **dict.fromkeys(
        ("rank_before", "opponent_rank_before", "rank_gap", "points_from_playoff_line",
         "is_mathematically_live"),
        "proxy",
    ),
    "points_from_relegation_line": "instrumented",
}
MART_KEYS = ("match_id", "season", "date", "home_club_id", "attendance", "is_covid_affected")
NULLABLE_FEATURES = LAGS

# Tables written out for the dashboard.
EXPORT_TABLES = (
    "mart_match_features", "int_standings", "predictions",
    "model_metrics", "feature_importance", "run_log",
)

# A group larger than this is split before it is sorted in one task.
ROWS_PER_TASK = 5_000_000
