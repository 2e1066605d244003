"""Schemas, feature order and aggregate maps for play-event tables.

Everything here is plain data; the operators read it so that a caller can
swap a map (e.g. the all-mean variant) without touching operator code.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------

# Play types kept by the play filter (original play_type, before relabelling).
KEPT_PLAY_TYPES = ("no_play", "pass", "run", "extra_point", "field_goal", "punt")

# Player columns removed right after the scan.
DROPPED_PLAYER_COLUMNS = (
    "passer_player_name",
    "passer_player_id",
    "rusher_player_name",
    "rusher_player_id",
    "receiver_player_name",
    "receiver_player_id",
)

# The 20 model features, in the order the models see them.
FEATURES = (
    "yardline_100",
    "yards_gained",
    "score_differential",
    "epa",
    "passing_yards",
    "rushing_yards",
    "penalty_yards",
    "cpoe",
    "pass",
    "rush",
    "fg_made",
    "fg_missed",
    "is_home_team",
    "first_down",
    "third_down_failed",
    "touchdown",
    "interception",
    "sack",
    "tackled_for_loss",
    "fumble",
)

# Earlier drafts leave out the last feature.
FEATURES_19 = FEATURES[:19]

# The earliest draft averages seven numeric columns straight from plays.
FEATURES_7 = (
    "yardline_100",
    "yards_gained",
    "score_differential",
    "epa",
    "passing_yards",
    "rushing_yards",
    "penalty_yards",
)

# Team-game aggregate: columns averaged; every other feature is summed.
GAME_MEAN_COLUMNS = ("yardline_100", "score_differential", "epa", "cpoe", "is_home_team")

# Variant with four yardage columns averaged instead of summed.
GAME_MEAN_COLUMNS_VARIANT = GAME_MEAN_COLUMNS + (
    "yards_gained",
    "passing_yards",
    "rushing_yards",
    "penalty_yards",
)

# Probability cut-offs of the threshold sweep, as double literals.
THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)

# Test seasons of the final script, and of the earlier drafts.
TEST_SEASONS_FINAL = ("2018", "2019", "2020")
TEST_SEASONS_DRAFT = ("2020",)

# Model names in leaderboard order, and the cut-off the author picked for each.
MODEL_CUTOFFS = (
    ("logit", 0.7),
    ("naive bayes", 0.9),
    ("SVM", 0.5),
    ("Kernel SVM", 0.4),
    ("Neural Net", 0.7),
    ("KNN", 0.1),
    ("CART", 0.1),
    ("Random Forest", 0.5),
    ("Adaboost", 0.5),
    ("Gradient Boosting", 0.4),
    ("NB-PCA", 0.5),
    ("Logit-PCA", 0.5),
    ("KNN-PCA", 0.1),
    ("SVM-PCA", 0.5),
    ("Kernel SVM-PCA", 0.5),
    ("Neural Network-PCA", 0.6),
    ("CART-PCA", 0.1),
    ("Random Forest-PCA", 0.5),
    ("Adaboost-PCA", 0.5),
    ("Gradient Boosting-PCA", 0.6),
)

# Number of importances shown by the feature ranking.
TOP_IMPORTANCES = 18

# Mesh step of the decision grid.
GRID_STEP = 0.5

# Kernel widths of the RBF SVM on all features and on two components.
RBF_GAMMA_FULL = 0.01
RBF_GAMMA_PCA = 0.001

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

PLAY_KEYS = ("year", "week", "game_id", "posteam")
SEASON_KEYS = ("year", "posteam")

_D = T.DoubleType()
_S = T.StringType()

# Source schema of one season's play-by-play CSV (the columns the pipeline
# reads; other columns of a real file are simply not named and so pruned).
PLAY_CSV_SCHEMA = T.StructType(
    [
        T.StructField("game_id", _S),
        T.StructField("home_team", _S),
        T.StructField("away_team", _S),
        T.StructField("season_type", _S),
        T.StructField("week", T.IntegerType()),
        T.StructField("posteam", _S),
        T.StructField("play_type", _S),
        T.StructField("field_goal_result", _S),
        T.StructField("epa", _D),
        T.StructField("pass", _D),
        T.StructField("rush", _D),
        T.StructField("yardline_100", _D),
        T.StructField("yards_gained", _D),
        T.StructField("score_differential", _D),
        T.StructField("passing_yards", _D),
        T.StructField("rushing_yards", _D),
        T.StructField("penalty_yards", _D),
        T.StructField("cpoe", _D),
        T.StructField("first_down", _D),
        T.StructField("third_down_failed", _D),
        T.StructField("touchdown", _D),
        T.StructField("interception", _D),
        T.StructField("sack", _D),
        T.StructField("tackled_for_loss", _D),
        T.StructField("fumble", _D),
    ]
    + [T.StructField(c, _S) for c in DROPPED_PLAYER_COLUMNS]
)

# Columns every play table must carry before feature work starts.
REQUIRED_PLAY_COLUMNS = (
    "year",
    "week",
    "game_id",
    "season_type",
    "home_team",
    "away_team",
    "posteam",
    "play_type",
    "field_goal_result",
    "epa",
    "pass",
    "rush",
) + tuple(c for c in FEATURES if c not in ("is_home_team", "fg_made", "fg_missed", "pass", "rush"))


def require_columns(df, columns) -> None:
    """Fail early, naming every missing column (pandas ``drop`` raises too)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
