"""Play → team-game → team-season feature operators.

Plan shape at scale (see README "Plans"): the play scan is pruned to the
columns named here and the ``season_type``/``play_type``/``epa`` predicates
are pushed into it. The team-game aggregate is a partial (map-side) hash
aggregate, so only one row per group and task crosses the shuffle even when
one team-season holds a third of the plays. The post-season team set is a
distinct over two columns (partial aggregate again) and is joined without a
``broadcast()`` hint: the planner broadcasts it only when its size statistic
is under the broadcast threshold, and AQE re-checks the real size at run time;
beyond that the join stays a sort-merge join with AQE skew splitting.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import eq_flag, mean_, nan_to_null, sum0, value_flag
from ..schema import (
    DROPPED_PLAYER_COLUMNS,
    FEATURES,
    FEATURES_7,
    GAME_MEAN_COLUMNS,
    KEPT_PLAY_TYPES,
    PLAY_KEYS,
    SEASON_KEYS,
    require_columns,
)

# The earliest draft keeps only three play types (fixed value).
KEPT_PLAY_TYPES_DRAFT = ("no_play", "pass", "run")


def drop_columns(df: DataFrame, columns: Iterable[str] = DROPPED_PLAYER_COLUMNS, strict: bool = True) -> DataFrame:
    """Drop columns; like pandas, fail when one is absent (Spark would ignore it)."""
    columns = list(columns)
    if strict:
        require_columns(df, columns)
    return df.drop(*columns)


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return df.select(*columns)


def filter_plays(df: DataFrame, play_types: Sequence[str] = KEPT_PLAY_TYPES) -> DataFrame:
    """Keep listed play types with a present ``epa`` (null play type is dropped)."""
    epa = F.col("epa")
    return df.filter(F.col("play_type").isin(*play_types) & epa.isNotNull() & ~F.isnan(epa))


def relabel_plays(df: DataFrame) -> DataFrame:
    """``pass == 1`` → 'pass', then ``rush == 1`` → 'run' (rush wins); after the filter."""
    return df.withColumn(
        "play_type",
        F.when(F.col("rush") == 1, F.lit("run"))
        .when(F.col("pass") == 1, F.lit("pass"))
        .otherwise(F.col("play_type")),
    )


def derive_flags(df: DataFrame) -> DataFrame:
    """``is_home_team``, ``fg_made``, ``fg_missed`` as 0/1 ints (missing → 0)."""
    return df.withColumns(
        {
            "is_home_team": eq_flag("home_team", "posteam"),
            "fg_made": value_flag("field_goal_result", "made"),
            "fg_missed": value_flag("field_goal_result", "missed"),
        }
    )


def fill_missing(df: DataFrame, enabled: bool = False) -> DataFrame:
    """The reference calls ``fillna(0)`` and discards the result: off by default."""
    return df.na.fill(0) if enabled else df


def prepare_plays(df: DataFrame, play_types: Sequence[str] = KEPT_PLAY_TYPES) -> DataFrame:
    """Player columns dropped (when present), plays filtered, relabelled, flagged."""
    present = [c for c in DROPPED_PLAYER_COLUMNS if c in df.columns]
    df = drop_columns(df, present)
    return derive_flags(relabel_plays(filter_plays(df, play_types)))


def season_teams(plays: DataFrame, season_type: str) -> DataFrame:
    """Distinct (year, team) over home and away teams of one season type."""
    return (
        plays.filter(F.col("season_type") == season_type)
        .select("year", F.explode(F.array("home_team", "away_team")).alias("team"))
        .filter(F.col("team").isNotNull() & F.col("year").isNotNull())
        .distinct()
    )


def post_teams(plays: DataFrame) -> DataFrame:
    """Teams that appear in a post-season game, per season."""
    return season_teams(plays, "POST")


def all_teams(plays: DataFrame) -> DataFrame:
    """Teams that appear in a regular-season game, per season."""
    return season_teams(plays, "REG")


def game_features(
    plays: DataFrame,
    features: Sequence[str] = FEATURES,
    mean_columns: Sequence[str] = GAME_MEAN_COLUMNS,
) -> DataFrame:
    """Regular-season team-game aggregate: mean for ``mean_columns``, sum for the rest.

    Sums follow pandas (missing skipped, all missing → 0); means skip missing
    values and NaN. Rows with a missing group key are left out.
    """
    keys = [F.col(k) for k in PLAY_KEYS]
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & k.isNotNull()
    aggs = [
        (mean_(nan_to_null(c)) if c in mean_columns else sum0(nan_to_null(c))).alias(c) for c in features
    ]
    return plays.filter((F.col("season_type") == "REG") & not_null).groupBy(*PLAY_KEYS).agg(*aggs)


def label_games(games: DataFrame, teams: DataFrame, label: str = "playoffs") -> DataFrame:
    """Flag rows whose (year, posteam) is in ``teams`` (same season only)."""
    t = teams.select(F.col("year").alias("_t_year"), F.col("team").alias("_t_team"), F.lit(1).alias("_hit"))
    joined = games.join(t, (games["year"] == t["_t_year"]) & (games["posteam"] == t["_t_team"]), "left")
    return joined.withColumn(label, F.coalesce(F.col("_hit"), F.lit(0))).drop("_t_year", "_t_team", "_hit")


def game_table(
    plays: DataFrame,
    features: Sequence[str] = FEATURES,
    mean_columns: Sequence[str] = GAME_MEAN_COLUMNS,
    prepared: bool = False,
) -> DataFrame:
    """Labelled team-game table: keys, features, ``playoffs``."""
    p = plays if prepared else prepare_plays(plays)
    return label_games(game_features(p, features, mean_columns), post_teams(p))


def season_features(games: DataFrame, features: Sequence[str] = FEATURES, label: str = "playoffs") -> DataFrame:
    """Team-season means of game rows (mean of games, not weighted by plays)."""
    aggs = [F.avg("week").alias("week")] + [F.avg(c).alias(c) for c in features]
    aggs.append(F.avg(F.col(label).cast("double")).alias(label))
    return games.groupBy(*SEASON_KEYS).agg(*aggs)


def season_table(
    plays: DataFrame,
    features: Sequence[str] = FEATURES,
    prepared: bool = False,
    mean_columns: Sequence[str] = GAME_MEAN_COLUMNS,
    label: str = "playoffs",
) -> DataFrame:
    """Full chain in one scan and two exchanges: plays → team-games → team-seasons with their label.

    Equals ``season_features(game_table(plays))``. A regular-season play counts for its team-game; a post-season play
    marks its two teams, as a group without a game. So the season aggregate meets a team's games and its
    mark under one key, and neither a second scan nor a join is needed.
    """
    p = plays if prepared else prepare_plays(plays)
    regular = (F.col("season_type") == "REG") & F.col("week").isNotNull() & F.col("game_id").isNotNull()

    def role(week, game, team, post: bool):
        return F.struct(week.alias("week"), game.alias("game_id"), team.alias("posteam"), F.lit(post).alias("post"))

    none = [F.lit(None).cast(p.schema[c].dataType) for c in ("week", "game_id")]
    roles = F.when(regular, F.array(role(F.col("week"), F.col("game_id"), F.col("posteam"), False))).when(
        F.col("season_type") == "POST", F.array(*[role(*none, F.col(c), True) for c in ("home_team", "away_team")])
    )
    values = [nan_to_null(c).alias(c) for c in features]
    rows = p.filter(F.col("season_type").isin("REG", "POST") & F.col("year").isNotNull())
    rows = rows.select("year", *values, F.explode(roles).alias("_r")).filter(F.col("_r.posteam").isNotNull())
    rows = rows.select("year", "_r.*", *features)
    aggs = [(mean_(c) if c in mean_columns else sum0(c)).alias(c) for c in features]
    games = rows.groupBy("year", "week", "game_id", "posteam", "post").agg(*aggs)
    of_games = lambda c: F.avg(F.when(~F.col("post"), F.col(c))).alias(c)
    seasons = games.groupBy(*SEASON_KEYS).agg(
        of_games("week"), *[of_games(c) for c in features],
        F.max(F.col("post").cast("double")).alias(label), F.count_if(~F.col("post")).alias("_games"),
    )
    return seasons.filter("_games > 0").drop("_games")


def season_features_direct(
    plays: DataFrame,
    columns: Sequence[str] = FEATURES_7 + ("cpoe",),
    label: str = "playoffs",
    prepared: bool = False,
) -> DataFrame:
    """One-step season means straight from regular-season plays (weighted by plays)."""
    p = plays if prepared else prepare_plays(plays, KEPT_PLAY_TYPES_DRAFT)
    reg = p.filter((F.col("season_type") == "REG") & F.col("posteam").isNotNull() & F.col("year").isNotNull())
    means = reg.groupBy(*SEASON_KEYS).agg(*[mean_(nan_to_null(c)).alias(c) for c in columns])
    return label_games(means, post_teams(p), label)
