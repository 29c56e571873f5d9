"""Fixed schemas and column mappings of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Unique key of the bronze log.
BRONZE_KEYS = ["SEASON", "GAME_ID", "PLAYER_ID"]

# Bronze -> silver projection (bronze name, silver name, target type).
# ``None`` keeps the bronze type.  Doubles, never 4-byte floats.
SILVER_MAPPING = [
    ("SEASON", "season", None),
    ("GAME_ID", "game_id", None),
    ("GAME_DATE", "game_date", "date"),
    ("PLAYER_ID", "player_id", None),
    ("PLAYER_NAME", "player_name", None),
    ("TEAM_ABBREVIATION", "team", None),
    ("MATCHUP", "matchup", None),
    ("MIN", "minutes", "double"),
    ("PTS", "pts", "double"),
    ("REB", "reb", "double"),
    ("AST", "ast", "double"),
    ("FGM", "fgm", "double"),
    ("FGA", "fga", "double"),
    ("FG3M", "fg3m", "double"),
    ("FG3A", "fg3a", "double"),
    ("FTM", "ftm", "double"),
    ("FTA", "fta", "double"),
    ("TOV", "tov", "double"),
    ("INGESTED_AT", "ingested_at", "timestamp"),
]

# Measures of the raw log, in feed order.
MEASURE_COLS = ["MIN", "PTS", "REB", "AST", "FGM", "FGA", "FG3M", "FG3A",
                "FTM", "FTA", "TOV"]

BRONZE_TEXT_SCHEMA = T.StructType(
    [T.StructField("SEASON", T.StringType()),
     T.StructField("GAME_ID", T.StringType()),
     T.StructField("GAME_DATE", T.StringType()),
     T.StructField("PLAYER_ID", T.LongType()),
     T.StructField("PLAYER_NAME", T.StringType()),
     T.StructField("TEAM_ABBREVIATION", T.StringType()),
     T.StructField("MATCHUP", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in MEASURE_COLS]
    + [T.StructField("INGESTED_AT", T.StringType())])

# Columns of the run log (row counts are 64-bit: a layer can exceed 2^31 rows).
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("layer", T.StringType(), False),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("runtime_seconds", T.DecimalType(18, 6)),
    T.StructField("error_message", T.StringType()),
    T.StructField("executed_at", T.TimestampType()),
])

# Allowed run statuses.
RUN_STATUSES = ("success", "failure", "partial", "warning")

# Gold.player_features column order.
PLAYER_FEATURE_COLS = [
    "season", "game_id", "game_date", "player_id", "player_name", "team",
    "opponent_team", "minutes", "pts", "reb", "ast",
    "pts_last3", "reb_last3", "ast_last3", "min_last3", "pts_next_game",
    "opp_pts_allowed_rank", "opp_reb_allowed_rank", "opp_ast_allowed_rank",
]

# The 14 columns of the recent-games report.
RECENT_GAME_COLS = [
    "game_date", "team", "opponent_team", "minutes", "pts", "reb", "ast",
    "pts_last3", "reb_last3", "ast_last3", "min_last3",
    "opp_pts_allowed_rank", "opp_reb_allowed_rank", "opp_ast_allowed_rank",
]

# Model features of the older pipeline.  The original list names
# the points rank twice and omits the assists rank; this is the intended list.
MODEL_FEATURES = ["PTS_LAST5", "REB_LAST5", "AST_LAST5", "MIN_LAST5",
                  "PRA_LAST5", "OPP_PTS_ALLOWED_RANK", "OPP_REB_ALLOWED_RANK",
                  "OPP_AST_ALLOWED_RANK"]
