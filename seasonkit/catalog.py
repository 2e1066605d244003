"""Registered queries and their DuckDB oracle SQL.

Every query reads the driver's tables (``lineitem`` through the stand-in play
view, ``embeddings`` for the learner fixture) so its work grows with them.
Floating outputs are rounded to a 2**-20 grid (about 6 decimals) on both
sides with the same arithmetic (see ``functions.round6``); integer outputs are
BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import round6
from .session import materialize, owns_tables
from .operators import features as fe
from .operators.split import FIXTURE_TEST_SEASONS, mark_split
from .schema import FEATURES, GAME_MEAN_COLUMNS_VARIANT, KEPT_PLAY_TYPES, MODEL_CUTOFFS, PLAY_KEYS, THRESHOLDS
from .sources import PLAYS_VIEW_SQL_DUCKDB, plays_from_lineitem

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = owns_tables(fn)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _r(cols):
    return [round6(c).alias(c) for c in cols]


def _sql_r(cols, prefix=""):
    return ", ".join(f"{sql_round6(prefix + c)} AS {c}" for c in cols)


def sql_round6(expr: str) -> str:
    return f"(round(({expr}) * CAST(1048576 AS DOUBLE)) / CAST(1048576 AS DOUBLE) + 0.0)"


def _in_list(values):
    return ", ".join(f"'{v}'" for v in values)


_PLAY_COLS_STR = ("year", "game_id", "season_type", "play_type", "field_goal_result")
_PLAY_COLS_INT = ("week", "posteam", "home_team", "away_team")
_PLAY_COLS_DBL = (
    "epa",
    "pass",
    "rush",
    "yardline_100",
    "yards_gained",
    "score_differential",
    "passing_yards",
    "rushing_yards",
    "penalty_yards",
    "cpoe",
    "first_down",
    "third_down_failed",
    "touchdown",
    "interception",
    "sack",
    "tackled_for_loss",
    "fumble",
)

# Common CTEs of the oracle: the play view, the filtered/flagged plays, the
# post-season teams, the game table and the season table.
SQL_PLAYS = f"plays AS ({PLAYS_VIEW_SQL_DUCKDB})"
SQL_F = (
    "f AS (SELECT * REPLACE (CASE WHEN rush = 1 THEN 'run' WHEN pass = 1 THEN 'pass' ELSE play_type END AS play_type),"
    " CASE WHEN home_team = posteam THEN 1 ELSE 0 END AS is_home_team,"
    " CASE WHEN field_goal_result = 'made' THEN 1 ELSE 0 END AS fg_made,"
    " CASE WHEN field_goal_result = 'missed' THEN 1 ELSE 0 END AS fg_missed"
    f" FROM plays WHERE play_type IN ({_in_list(KEPT_PLAY_TYPES)}) AND epa IS NOT NULL AND NOT isnan(epa))"
)
SQL_PO = (
    "po AS (SELECT year, home_team AS team FROM f WHERE season_type = 'POST' AND home_team IS NOT NULL"
    " UNION SELECT year, away_team FROM f WHERE season_type = 'POST' AND away_team IS NOT NULL)"
)


def _sql_game(mean_cols, name="g", features=FEATURES):
    aggs = []
    for c in features:
        if c in mean_cols:
            aggs.append(f"avg(CAST({c} AS DOUBLE)) AS {c}")
        else:
            aggs.append(f"coalesce(sum(CAST({c} AS DOUBLE)), 0) AS {c}")
    return (
        f"{name} AS (SELECT year, week, game_id, posteam, {', '.join(aggs)} FROM f"
        " WHERE season_type = 'REG' AND year IS NOT NULL AND week IS NOT NULL AND game_id IS NOT NULL"
        " AND posteam IS NOT NULL GROUP BY year, week, game_id, posteam)"
    )


SQL_G = _sql_game(fe.GAME_MEAN_COLUMNS)
SQL_GL = (
    "gl AS (SELECT g.*, CASE WHEN po.team IS NULL THEN 0 ELSE 1 END AS playoffs"
    " FROM g LEFT JOIN po ON g.year = po.year AND g.posteam = po.team)"
)
SQL_SE = (
    "se AS (SELECT year, posteam, avg(week) AS week, "
    + ", ".join(f"avg({c}) AS {c}" for c in FEATURES)
    + ", avg(CAST(playoffs AS DOUBLE)) AS playoffs FROM gl GROUP BY year, posteam)"
)
SQL_SEASON_CTES = ",\n".join([SQL_PLAYS, SQL_F, SQL_PO, SQL_G, SQL_GL, SQL_SE])


def prepared_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.prepare_plays(plays_from_lineitem(spark, sf_dir))


def season_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season feature table of the stand-in plays, ``is_test`` marked."""
    seasons = fe.season_table(prepared_plays(spark, sf_dir), prepared=True)
    return mark_split(seasons, FIXTURE_TEST_SEASONS)


# ---------------------------------------------------------------------------
# 1. Relational core
# ---------------------------------------------------------------------------


def _play_out(df: DataFrame, extra_int=()) -> DataFrame:
    return df.select(
        *_PLAY_COLS_STR,
        *[F.col(c).cast("bigint").alias(c) for c in _PLAY_COLS_INT + tuple(extra_int)],
        *_r(_PLAY_COLS_DBL),
    )


def _sql_play_out(src: str, extra_int=(), where: str = "") -> str:
    ints = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _PLAY_COLS_INT + tuple(extra_int))
    return f"SELECT {', '.join(_PLAY_COLS_STR)}, {ints}, {_sql_r(_PLAY_COLS_DBL)} FROM {src} {where}"


@register(
    "filter_plays",
    f"WITH {SQL_PLAYS} "
    + _sql_play_out(
        "plays", where=f"WHERE play_type IN ({_in_list(KEPT_PLAY_TYPES)}) AND epa IS NOT NULL AND NOT isnan(epa)"
    ),
)
def q_filter_plays(spark, sf_dir):
    return _play_out(fe.filter_plays(plays_from_lineitem(spark, sf_dir)))


@register(
    "relabel_plays",
    f"WITH {SQL_PLAYS}, {SQL_F} " + _sql_play_out("f"),
)
def q_relabel_plays(spark, sf_dir):
    return _play_out(fe.relabel_plays(fe.filter_plays(plays_from_lineitem(spark, sf_dir))))


@register(
    "derive_flags",
    f"WITH {SQL_PLAYS}, {SQL_F} " + _sql_play_out("f", extra_int=("is_home_team", "fg_made", "fg_missed")),
)
def q_derive_flags(spark, sf_dir):
    return _play_out(prepared_plays(spark, sf_dir), extra_int=("is_home_team", "fg_made", "fg_missed"))


@register(
    "post_teams",
    f"WITH {SQL_PLAYS}, {SQL_F}, {SQL_PO} SELECT year, CAST(team AS BIGINT) AS team FROM po",
)
def q_post_teams(spark, sf_dir):
    return fe.post_teams(prepared_plays(spark, sf_dir)).select("year", F.col("team").cast("bigint"))


@register(
    "all_teams",
    f"WITH {SQL_PLAYS}, {SQL_F} SELECT year, home_team AS team FROM f WHERE season_type = 'REG'"
    " AND home_team IS NOT NULL UNION SELECT year, away_team FROM f WHERE season_type = 'REG' AND away_team IS NOT NULL",
)
def q_all_teams(spark, sf_dir):
    return fe.all_teams(prepared_plays(spark, sf_dir)).select("year", F.col("team").cast("bigint"))


def _game_out(df: DataFrame) -> DataFrame:
    return df.select(
        "year",
        F.col("week").cast("bigint").alias("week"),
        "game_id",
        F.col("posteam").cast("bigint").alias("posteam"),
        *_r(FEATURES),
        F.col("playoffs").cast("bigint").alias("playoffs"),
    )


def _sql_game_out(src: str) -> str:
    return (
        f"SELECT year, CAST(week AS BIGINT) AS week, game_id, CAST(posteam AS BIGINT) AS posteam,"
        f" {_sql_r(FEATURES)}, CAST(playoffs AS BIGINT) AS playoffs FROM {src}"
    )


@register(
    "game_features_sum",
    f"WITH {SQL_PLAYS}, {SQL_F}, {SQL_PO}, {SQL_G}, {SQL_GL} " + _sql_game_out("gl"),
)
def q_game_features_sum(spark, sf_dir):
    return _game_out(fe.game_table(prepared_plays(spark, sf_dir), prepared=True))


_SQL_G_MEAN = _sql_game(GAME_MEAN_COLUMNS_VARIANT, name="gm")


@register(
    "game_features_mean",
    f"WITH {SQL_PLAYS}, {SQL_F}, {SQL_PO}, {_SQL_G_MEAN}, gml AS (SELECT gm.*, CASE WHEN po.team IS NULL THEN 0"
    " ELSE 1 END AS playoffs FROM gm LEFT JOIN po ON gm.year = po.year AND gm.posteam = po.team) "
    + _sql_game_out("gml"),
)
def q_game_features_mean(spark, sf_dir):
    return _game_out(
        fe.game_table(prepared_plays(spark, sf_dir), mean_columns=GAME_MEAN_COLUMNS_VARIANT, prepared=True)
    )


_SEASON_DBL = ("week",) + FEATURES + ("playoffs",)


def _season_out(df: DataFrame) -> DataFrame:
    return df.select("year", F.col("posteam").cast("bigint").alias("posteam"), *_r(_SEASON_DBL))


@register(
    "season_features",
    f"WITH {SQL_SEASON_CTES} SELECT year, CAST(posteam AS BIGINT) AS posteam, {_sql_r(_SEASON_DBL)} FROM se",
)
def q_season_features(spark, sf_dir):
    return _season_out(fe.season_table(prepared_plays(spark, sf_dir), prepared=True))


_DIRECT_COLS = fe.FEATURES_7 + ("cpoe",)


@register(
    "season_features_direct",
    f"WITH {SQL_PLAYS}, fd AS (SELECT * FROM plays WHERE play_type IN ({_in_list(fe.KEPT_PLAY_TYPES_DRAFT)})"
    " AND epa IS NOT NULL AND NOT isnan(epa)),"
    " pod AS (SELECT year, home_team AS team FROM fd WHERE season_type = 'POST' AND home_team IS NOT NULL"
    " UNION SELECT year, away_team FROM fd WHERE season_type = 'POST' AND away_team IS NOT NULL),"
    " sd AS (SELECT year, posteam, "
    + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS {c}" for c in _DIRECT_COLS)
    + " FROM fd WHERE season_type = 'REG' AND posteam IS NOT NULL AND year IS NOT NULL GROUP BY year, posteam)"
    " SELECT sd.year, CAST(sd.posteam AS BIGINT) AS posteam, "
    + _sql_r(_DIRECT_COLS, "sd.")
    + ", CAST(CASE WHEN pod.team IS NULL THEN 0 ELSE 1 END AS BIGINT) AS playoffs"
    " FROM sd LEFT JOIN pod ON sd.year = pod.year AND sd.posteam = pod.team",
)
def q_season_features_direct(spark, sf_dir):
    df = fe.season_features_direct(plays_from_lineitem(spark, sf_dir))
    return df.select(
        "year",
        F.col("posteam").cast("bigint").alias("posteam"),
        *_r(_DIRECT_COLS),
        F.col("playoffs").cast("bigint").alias("playoffs"),
    )


_F19 = FEATURES[:19]
_SEASON19_DBL = ("week",) + _F19 + ("playoffs",)


@register(
    "season_features_draft",
    f"WITH {SQL_PLAYS}, {SQL_F}, {SQL_PO}, {_sql_game(GAME_MEAN_COLUMNS_VARIANT, 'g19', _F19)},"
    " gl19 AS (SELECT g19.*, CASE WHEN po.team IS NULL THEN 0 ELSE 1 END AS playoffs FROM g19 LEFT JOIN po"
    " ON g19.year = po.year AND g19.posteam = po.team),"
    " se19 AS (SELECT year, posteam, avg(week) AS week, "
    + ", ".join(f"avg({c}) AS {c}" for c in _F19)
    + ", avg(CAST(playoffs AS DOUBLE)) AS playoffs FROM gl19 GROUP BY year, posteam)"
    f" SELECT year, CAST(posteam AS BIGINT) AS posteam, {_sql_r(_SEASON19_DBL)} FROM se19",
)
def q_season_features_draft(spark, sf_dir):
    """The earliest game-level draft: 19 features, yardage columns averaged per game."""
    games = fe.game_table(prepared_plays(spark, sf_dir), _F19, GAME_MEAN_COLUMNS_VARIANT, prepared=True)
    seasons = fe.season_features(games, _F19)
    return seasons.select("year", F.col("posteam").cast("bigint").alias("posteam"), *_r(_SEASON19_DBL))


@register(
    "train_test_split",
    f"WITH {SQL_SEASON_CTES} SELECT CASE WHEN year IN ({_in_list(FIXTURE_TEST_SEASONS)}) THEN 'test' ELSE 'train' END"
    " AS split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN playoffs > 0 THEN 1 ELSE 0 END) AS BIGINT)"
    " AS n_positive, " + sql_round6("avg(epa)") + " AS mean_epa FROM se GROUP BY 1",
)
def q_train_test_split(spark, sf_dir):
    st = season_table(spark, sf_dir)
    return st.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("split")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(F.when(F.col("playoffs") > 0, 1).otherwise(0)).cast("bigint").alias("n_positive"),
        round6(F.avg("epa")).alias("mean_epa"),
    )




# ---------------------------------------------------------------------------
# 2. Evaluation over SQL-expressible scorers (Gaussian NB, exact 1-NN)
# ---------------------------------------------------------------------------

KEYS = ["year", "posteam"]
_TEST_IN = _in_list(FIXTURE_TEST_SEASONS)


def labelled_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season table with ``label``, materialised once in the shared folder:
    every learner job below reads it instead of re-aggregating the plays."""
    st = season_table(spark, sf_dir).withColumn("label", F.col("playoffs"))
    return materialize(st, "seasons")


def split_seasons(spark: SparkSession, sf_dir: str):
    st = labelled_seasons(spark, sf_dir)
    return st.filter(~F.col("is_test")), st.filter(F.col("is_test"))


def nb_knn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table of the two SQL-expressible models on the test seasons,
    plus ``score`` = p1 rounded to 6 places (the ranking score of the curves)."""
    from .plans.learners import fit_score

    train, test = split_seasons(spark, sf_dir)
    nb = fit_score("naive_bayes", train, test, FEATURES, KEYS, "naive bayes", 2)
    knn = fit_score("knn", train, test, FEATURES, KEYS, "KNN", 6)
    return nb.unionByName(knn).withColumn("score", round6("p1"))


_F = FEATURES
SQL_SPLIT = (
    f"tr AS (SELECT * FROM se WHERE year NOT IN ({_TEST_IN})), te AS (SELECT * FROM se WHERE year IN ({_TEST_IN}))"
)
SQL_NB = (
    "cls AS (SELECT playoffs AS c, count(*) AS nc, "
    + ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in _F)
    + " FROM tr GROUP BY playoffs),"
    " tot AS (SELECT count(*) AS n, 1e-9 * greatest("
    + ", ".join(f"var_pop({c})" for c in _F)
    + ") AS eps FROM tr),"
    " jl AS (SELECT te.year, te.posteam, te.playoffs AS label, cls.c, ln(cls.nc / tot.n) - 0.5 * ("
    + " + ".join(f"ln(2 * pi() * (v_{c} + eps))" for c in _F)
    + ") - 0.5 * ("
    + " + ".join(f"(te.{c} - m_{c}) * (te.{c} - m_{c}) / (v_{c} + eps)" for c in _F)
    + ") AS j FROM te CROSS JOIN cls CROSS JOIN tot),"
    " nb AS (SELECT year, posteam, label, 1.0 / (1.0 + exp(max(CASE WHEN c = 0 THEN j END)"
    " - max(CASE WHEN c = 1 THEN j END))) AS p1 FROM jl GROUP BY year, posteam, label)"
)
SQL_KNN = (
    "dd AS (SELECT te.year, te.posteam, te.playoffs AS label, tr.playoffs AS nl, tr.year AS ty, tr.posteam AS tp, "
    + " + ".join(f"(te.{c} - tr.{c}) * (te.{c} - tr.{c})" for c in _F)
    + " AS d2 FROM te CROSS JOIN tr),"
    " kn AS (SELECT year, posteam, label, nl AS p1, sqrt(d2) AS nn_dist FROM (SELECT *, row_number() OVER"
    " (PARTITION BY year, posteam ORDER BY d2, ty, tp) AS rn FROM dd) WHERE rn = 1)"
)
SQL_SCORES = (
    "sc AS (SELECT 'naive bayes' AS model, 2 AS model_ord, year, posteam, label, p1,"
    " CAST(CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM nb"
    " UNION ALL SELECT 'KNN', 6, year, posteam, label, p1, p1 FROM kn),"
    " scr AS (SELECT *, " + sql_round6("p1") + " AS score FROM sc)"
)
SQL_EVAL_CTES = ",\n".join([SQL_SEASON_CTES, SQL_SPLIT, SQL_NB, SQL_KNN, SQL_SCORES])
SQL_THRESHOLDS = (
    "th AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES "
    + ", ".join(f"({t})" for t in THRESHOLDS)
    + ") v(t)),"
    " cc AS (SELECT model, model_ord, threshold,"
    " CAST(sum(CASE WHEN p1 > threshold AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,"
    " CAST(sum(CASE WHEN p1 > threshold AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,"
    " CAST(sum(CASE WHEN NOT p1 > threshold AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,"
    " CAST(sum(CASE WHEN NOT p1 > threshold AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,"
    " CAST(count(*) AS BIGINT) AS n FROM sc CROSS JOIN th GROUP BY model, model_ord, threshold)"
)


@register(
    "gaussian_nb_scores",
    f"WITH {SQL_EVAL_CTES} SELECT year, CAST(posteam AS BIGINT) AS posteam, label, {sql_round6('p1')} AS p1,"
    " prediction FROM sc WHERE model = 'naive bayes'",
)
def q_gaussian_nb_scores(spark, sf_dir):
    from .plans.learners import fit_score

    train, test = split_seasons(spark, sf_dir)
    nb = fit_score("naive_bayes", train, test, FEATURES, KEYS, "naive bayes", 2)
    return nb.select("year", F.col("posteam").cast("bigint"), "label", round6("p1").alias("p1"), "prediction")


@register(
    "nearest_neighbour",
    f"WITH {SQL_EVAL_CTES} SELECT year, CAST(posteam AS BIGINT) AS posteam, label, p1 AS nn_label,"
    f" {sql_round6('nn_dist')} AS nn_dist FROM kn",
)
def q_nearest_neighbour(spark, sf_dir):
    from .operators.nearest import nearest_neighbour

    train, test = split_seasons(spark, sf_dir)
    nn = nearest_neighbour(train, test, FEATURES, "label", KEYS, KEYS)
    out = test.select(*KEYS, "label").join(nn.hint("merge"), KEYS)
    return out.select("year", F.col("posteam").cast("bigint"), "label", "nn_label", round6("nn_dist").alias("nn_dist"))


@register("nearest_neighbour_lsh")
def q_nearest_neighbour_lsh(spark, sf_dir):
    """The same by locality-sensitive probing: a distance may exceed the exact one (recall is tested)."""
    from .operators.lsh import approximate_neighbour

    train, test = split_seasons(spark, sf_dir)
    nn = approximate_neighbour(train, test, FEATURES, "label", KEYS, KEYS)
    return nn.select("year", F.col("posteam").cast("bigint"), "nn_label", round6("nn_dist").alias("nn_dist"))


_SQL_ACC = sql_round6("(tp + tn) / n")


@register(
    "threshold_sweep",
    f"WITH {SQL_EVAL_CTES}, {SQL_THRESHOLDS} SELECT model, CAST(model_ord AS BIGINT) AS model_ord, threshold,"
    f" {_SQL_ACC} AS accuracy FROM cc",
)
def q_threshold_sweep(spark, sf_dir):
    from .operators.evaluate import threshold_sweep

    lb = threshold_sweep(nb_knn_scores(spark, sf_dir))
    return lb.select("model", F.col("model_ord").cast("bigint"), "threshold", round6("accuracy").alias("accuracy"))


@register(
    "confusion_matrix",
    f"WITH {SQL_EVAL_CTES}, {SQL_THRESHOLDS} SELECT model, CAST(model_ord AS BIGINT) AS model_ord, threshold,"
    " CAST(a AS BIGINT) AS actual, CAST(p AS BIGINT) AS predicted, CAST(CASE WHEN a = 0 AND p = 0 THEN tn"
    " WHEN a = 0 THEN fp WHEN p = 0 THEN fn ELSE tp END AS BIGINT) AS n FROM cc CROSS JOIN (VALUES (0, 0), (0, 1),"
    " (1, 0), (1, 1)) cell(a, p)",
)
def q_confusion_matrix(spark, sf_dir):
    from .operators.evaluate import confusion_matrix

    cm = confusion_matrix(nb_knn_scores(spark, sf_dir))
    return cm.select(
        "model",
        F.col("model_ord").cast("bigint"),
        "threshold",
        F.col("actual").cast("bigint"),
        F.col("predicted").cast("bigint"),
        F.col("n").cast("bigint"),
    )


def _sql_report(cc: str) -> str:
    """Classification report rows from a confusion-count CTE name."""
    return (
        f"rp AS (SELECT *, (tp + tn) / n AS acc,"
        " CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,"
        " CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0, tn + fp AS s0, (2 * tn + fp + fn) > 0 AS in0,"
        " CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,"
        " CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1, tp + fn AS s1, (2 * tp + fp + fn) > 0 AS in1"
        f" FROM {cc}),"
        " rf AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,"
        " CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,"
        " CAST(in0 AS INTEGER) + CAST(in1 AS INTEGER) AS k FROM rp),"
        " rr AS ("
        "SELECT model, model_ord, threshold, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM rf WHERE in0"
        " UNION ALL SELECT model, model_ord, threshold, '1', p1, r1, f1, s1 FROM rf WHERE in1"
        " UNION ALL SELECT model, model_ord, threshold, 'accuracy', NULL, NULL, acc, n FROM rf"
        " UNION ALL SELECT model, model_ord, threshold, 'macro avg',"
        " ((CASE WHEN in0 THEN p0 ELSE 0.0 END) + (CASE WHEN in1 THEN p1 ELSE 0.0 END)) / k,"
        " ((CASE WHEN in0 THEN r0 ELSE 0.0 END) + (CASE WHEN in1 THEN r1 ELSE 0.0 END)) / k,"
        " ((CASE WHEN in0 THEN f0 ELSE 0.0 END) + (CASE WHEN in1 THEN f1 ELSE 0.0 END)) / k, n FROM rf"
        " UNION ALL SELECT model, model_ord, threshold, 'weighted avg', (p0 * s0 + p1 * s1) / n,"
        " (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM rf)"
        " SELECT model, CAST(model_ord AS BIGINT) AS model_ord, threshold, class, "
        + ", ".join(sql_round6(c) + f" AS {c}" for c in ("precision", "recall", "f1"))
        + ", CAST(support AS BIGINT) AS support FROM rr"
    )


def _report_out(df: DataFrame) -> DataFrame:
    return df.select(
        "model",
        F.col("model_ord").cast("bigint"),
        "threshold",
        "class",
        *_r(("precision", "recall", "f1")),
        F.col("support").cast("bigint"),
    )


@register("classification_report", f"WITH {SQL_EVAL_CTES}, {SQL_THRESHOLDS}, " + _sql_report("cc"))
def q_classification_report(spark, sf_dir):
    from .operators.evaluate import classification_report

    return _report_out(classification_report(nb_knn_scores(spark, sf_dir)))


_SQL_PRED = (
    "pc AS (SELECT model, model_ord, CAST(NULL AS DOUBLE) AS threshold,"
    " CAST(sum(CASE WHEN prediction = 1 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,"
    " CAST(sum(CASE WHEN prediction = 1 AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,"
    " CAST(sum(CASE WHEN prediction <> 1 AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,"
    " CAST(sum(CASE WHEN prediction <> 1 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,"
    " CAST(count(*) AS BIGINT) AS n FROM sc GROUP BY model, model_ord)"
)


@register("prediction_report", f"WITH {SQL_EVAL_CTES}, {_SQL_PRED}, " + _sql_report("pc"))
def q_prediction_report(spark, sf_dir):
    from .operators.evaluate import prediction_report

    return _report_out(prediction_report(nb_knn_scores(spark, sf_dir)))


_SQL_CUT = (
    "cut AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{m}', CAST({t} AS DOUBLE))" for m, t in MODEL_CUTOFFS)
    + ") v(model, cutoff)),"
    " ccut AS (SELECT sc.model, sc.model_ord, cut.cutoff AS threshold,"
    " CAST(sum(CASE WHEN p1 > cutoff AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,"
    " CAST(sum(CASE WHEN p1 > cutoff AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,"
    " CAST(sum(CASE WHEN NOT p1 > cutoff AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,"
    " CAST(sum(CASE WHEN NOT p1 > cutoff AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,"
    " CAST(count(*) AS BIGINT) AS n FROM sc JOIN cut ON sc.model = cut.model GROUP BY sc.model, sc.model_ord, cut.cutoff)"
)


@register("report_at_cutoffs", f"WITH {SQL_EVAL_CTES}, {_SQL_CUT}, " + _sql_report("ccut"))
def q_report_at_cutoffs(spark, sf_dir):
    from .operators.evaluate import cutoff_table, report_at_cutoffs

    return _report_out(report_at_cutoffs(nb_knn_scores(spark, sf_dir), cutoff_table(spark)))


_SQL_LB = "lb AS (SELECT model, model_ord, threshold, (tp + tn) / n AS accuracy FROM cc)"


@register(
    "best_overall",
    f"WITH {SQL_EVAL_CTES}, {SQL_THRESHOLDS}, {_SQL_LB} SELECT model, CAST(model_ord AS BIGINT) AS model_ord,"
    f" threshold, {sql_round6('accuracy')} AS accuracy, round_even(accuracy * 100.0, 2) AS accuracy_pct FROM lb"
    " ORDER BY lb.accuracy DESC, model_ord, threshold LIMIT 1",
)
def q_best_overall(spark, sf_dir):
    from .operators.evaluate import best_overall, threshold_sweep

    b = best_overall(threshold_sweep(nb_knn_scores(spark, sf_dir)))
    return b.select(
        "model", F.col("model_ord").cast("bigint"), "threshold", round6("accuracy").alias("accuracy"), "accuracy_pct"
    )


@register(
    "best_per_model",
    f"WITH {SQL_EVAL_CTES}, {SQL_THRESHOLDS}, {_SQL_LB} SELECT model, CAST(model_ord AS BIGINT) AS model_ord,"
    f" threshold, {sql_round6('accuracy')} AS accuracy FROM (SELECT *, row_number() OVER (PARTITION BY model"
    " ORDER BY accuracy DESC, threshold) AS rn FROM lb) WHERE rn = 1",
)
def q_best_per_model(spark, sf_dir):
    from .operators.evaluate import best_per_model, threshold_sweep

    b = best_per_model(threshold_sweep(nb_knn_scores(spark, sf_dir)))
    return b.select("model", F.col("model_ord").cast("bigint"), "threshold", round6("accuracy").alias("accuracy"))


# ROC over distinct scores: running counts, collinear interior points dropped.
_SQL_ROC = (
    "sg AS (SELECT model, model_ord, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,"
    " sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM scr GROUP BY model, model_ord, score),"
    " rc AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, lead(pos) OVER w2 AS np_, lead(neg) OVER w2 AS nn_,"
    " row_number() OVER w2 AS k, sum(pos) OVER (PARTITION BY model) AS tp_all, sum(neg) OVER (PARTITION BY model) AS tn_all"
    " FROM sg WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),"
    " w2 AS (PARTITION BY model ORDER BY score DESC))"
)


@register(
    "roc_points",
    f"WITH {SQL_EVAL_CTES}, {_SQL_ROC} SELECT model, CAST(model_ord AS BIGINT) AS model_ord, score AS threshold,"
    f" {sql_round6('CASE WHEN tn_all > 0 THEN cn / tn_all END')} AS fpr,"
    f" {sql_round6('CASE WHEN tp_all > 0 THEN cp / tp_all END')} AS tpr FROM rc"
    " WHERE k = 1 OR np_ IS NULL OR np_ <> pos OR nn_ <> neg"
    " UNION ALL SELECT model, CAST(model_ord AS BIGINT), NULL, CASE WHEN tn_all > 0 THEN 0.0 END,"
    " CASE WHEN tp_all > 0 THEN 0.0 END FROM rc WHERE k = 1",
)
def q_roc_points(spark, sf_dir):
    from .operators.curves import roc_points

    r = roc_points(nb_knn_scores(spark, sf_dir))
    return r.select("model", F.col("model_ord").cast("bigint"), "threshold", *_r(("fpr", "tpr")))


@register(
    "auc",
    f"WITH {SQL_EVAL_CTES}, {_SQL_ROC}, pts AS (SELECT model, model_ord, cn / tn_all AS x, cp / tp_all AS y, k"
    " FROM rc WHERE tn_all > 0 AND tp_all > 0 UNION ALL SELECT DISTINCT model, model_ord, 0.0, 0.0, 0 FROM rc"
    " WHERE tn_all > 0 AND tp_all > 0), tz AS (SELECT model, model_ord, (x - lag(x) OVER o) * (y + lag(y) OVER o) / 2"
    " AS a FROM pts WINDOW o AS (PARTITION BY model ORDER BY k))"
    f" SELECT model, CAST(model_ord AS BIGINT) AS model_ord, {sql_round6('sum(a)')} AS auc FROM tz GROUP BY model, model_ord",
)
def q_auc(spark, sf_dir):
    from .operators.curves import auc

    a = auc(nb_knn_scores(spark, sf_dir))
    return a.select("model", F.col("model_ord").cast("bigint"), round6("auc").alias("auc"))




@register(
    "confusion_observed",
    f"WITH {SQL_EVAL_CTES} SELECT model, label AS actual, prediction AS predicted, CAST(count(*) AS BIGINT) AS n"
    " FROM sc GROUP BY model, label, prediction",
)
def q_confusion_observed(spark, sf_dir):
    from .operators.evaluate import confusion_observed

    return confusion_observed(nb_knn_scores(spark, sf_dir))


# ---------------------------------------------------------------------------
# 3. Feature ranking, decision grid, CSV round trip
# ---------------------------------------------------------------------------


@register(
    "top_importances_corr",
    f"WITH {SQL_SEASON_CTES}, {SQL_SPLIT}, ci AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, playoffs)) AS importance FROM tr" for c in FEATURES)
    + f") SELECT feature, {sql_round6('importance')} AS importance FROM ci"
    " ORDER BY ci.importance DESC, feature DESC LIMIT 18",
)
def q_top_importances_corr(spark, sf_dir):
    from .operators.explain import label_correlations, top_importances

    train, _ = split_seasons(spark, sf_dir)
    top = top_importances(label_correlations(train, FEATURES, "label"))
    return top.select("feature", round6("importance").alias("importance"))


GRID_X, GRID_Y = "yardline_100", "cpoe"
_G2 = (GRID_X, GRID_Y)


@register(
    "decision_grid",
    f"WITH {SQL_SEASON_CTES}, {SQL_SPLIT},"
    f" gb AS (SELECT min({GRID_X}) AS x0, max({GRID_X}) AS x1, min({GRID_Y}) AS y0, max({GRID_Y}) AS y1 FROM tr),"
    " gn AS (SELECT x0, y0, CAST(ceil((x1 - x0) / 0.5) AS BIGINT) AS nx, CAST(ceil((y1 - y0) / 0.5) AS BIGINT) AS ny FROM gb),"
    f" gx AS (SELECT x0 + CAST(unnest(range(nx)) AS DOUBLE) * 0.5 AS {GRID_X} FROM gn),"
    f" gy AS (SELECT y0 + CAST(unnest(range(ny)) AS DOUBLE) * 0.5 AS {GRID_Y} FROM gn),"
    " gp AS (SELECT * FROM gx CROSS JOIN gy),"
    " gc AS (SELECT playoffs AS c, count(*) AS nc, "
    + ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in _G2)
    + " FROM tr GROUP BY playoffs),"
    " gt AS (SELECT count(*) AS n, 1e-9 * greatest("
    + ", ".join(f"var_pop({c})" for c in _G2)
    + ") AS eps FROM tr),"
    " gj AS (SELECT gp.*, c, ln(nc / n) - 0.5 * ("
    + " + ".join(f"ln(2 * pi() * (v_{c} + eps))" for c in _G2)
    + ") - 0.5 * ("
    + " + ".join(f"(gp.{c} - m_{c}) * (gp.{c} - m_{c}) / (v_{c} + eps)" for c in _G2)
    + f") AS j FROM gp CROSS JOIN gc CROSS JOIN gt)"
    f" SELECT {sql_round6(GRID_X)} AS {GRID_X}, {sql_round6(GRID_Y)} AS {GRID_Y}, CAST(CASE WHEN"
    " max(CASE WHEN c = 1 THEN j END) > max(CASE WHEN c = 0 THEN j END) THEN 1 ELSE 0 END AS DOUBLE) AS predicted"
    f" FROM gj GROUP BY {GRID_X}, {GRID_Y}",
)
def q_decision_grid(spark, sf_dir):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler

    from .operators.explain import decision_grid

    train, _ = split_seasons(spark, sf_dir)
    va = VectorAssembler(inputCols=list(_G2), outputCol="features")
    nb = NaiveBayes(modelType="gaussian").fit(va.transform(train))
    grid = decision_grid(train, GRID_X, GRID_Y, lambda pts: nb.transform(va.transform(pts)))
    return grid.select(*_r(_G2), "predicted")


@register(
    "csv_scan",
    f"WITH {SQL_SEASON_CTES} SELECT year, CAST(posteam AS BIGINT) AS posteam, {_sql_r(_SEASON_DBL)} FROM se",
)
def q_csv_scan(spark, sf_dir):
    """Plays written as gzip CSV season folders (``NA`` for missing) in the
    shared folder, scanned back by column name, then the full season chain."""
    from .session import scratch_path
    from .sources import read_play_files, write_seasons

    plays = plays_from_lineitem(spark, sf_dir)
    path = write_seasons(plays, scratch_path(spark, "plays-csv"), fmt="csv", mode="error")
    back = read_play_files(spark, path, fmt="csv")
    return _season_out(fe.season_table(back))


@register(
    "csv_scan_unlike_headers",
    f"WITH {SQL_SEASON_CTES} SELECT year, CAST(posteam AS BIGINT) AS posteam, {_sql_r(_SEASON_DBL)} FROM se",
)
def q_csv_scan_unlike_headers(spark, sf_dir):
    """Plays written as gzip CSV seasons in three column orders, one with an extra column, the season only
    in the file name; scanned back by header and column name, then the full season chain."""
    from .session import scratch_path
    from .sources import read_play_files

    plays = plays_from_lineitem(spark, sf_dir)
    names = [c for c in plays.columns if c != "year"]
    season = F.concat(F.lit("play_by_play_"), F.col("year")).alias("season")
    folders = []
    for k, columns in enumerate((names, names[::-1], ["play_id", *names[7:], *names[:7]])):
        part = plays.filter(F.pmod(F.col("year").cast("int"), F.lit(3)) == k).withColumn("play_id", F.lit(k))
        folders.append(scratch_path(spark, f"plays-order-{k}"))
        writer = part.select(*columns, season).write.partitionBy("season").option("compression", "gzip")
        writer.csv(folders[-1], header=True, nullValue="NA")
    return _season_out(fe.season_table(read_play_files(spark, folders)))


def test_seasons_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season table written partitioned by season, read back for the test
    seasons only: the season predicate prunes ``year=`` folders."""
    from .session import scratch_path
    from .sources import write_seasons

    path = write_seasons(season_table(spark, sf_dir).drop("is_test"), scratch_path(spark, "seasons"), mode="error")
    back = spark.read.parquet(path)
    return back.filter(F.col("year").cast("string").isin(*FIXTURE_TEST_SEASONS)).withColumn(
        "year", F.col("year").cast("string")
    )


@register(
    "test_seasons_pruned",
    f"WITH {SQL_SEASON_CTES} SELECT year, CAST(posteam AS BIGINT) AS posteam, {_sql_r(_SEASON_DBL)} FROM se"
    f" WHERE year IN ({_TEST_IN})",
)
def q_test_seasons_pruned(spark, sf_dir):
    return _season_out(test_seasons_written(spark, sf_dir))


# ---------------------------------------------------------------------------
# 4. Learners. SQL says what it can: components, logistic regression, the first boosting rounds, seasons left out.
# ---------------------------------------------------------------------------


def _sql_component(cov: str, name: str, squarings: int = 16) -> str:
    """CTEs for the first principal axis of the covariance table ``cov`` (i, j, c): repeated squaring leaves the
    projection on it; its largest loading is positive. ``name`` (i, v), ``name``_value (its variance)."""
    steps = [f"{name}0 AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM {cov} WHERE i = j) AS c FROM {cov})"]
    for k in range(squarings):
        steps.append(
            f"{name}_{k} AS MATERIALIZED (SELECT a.i, b.j, sum(a.c * b.c) AS c FROM {name}{k} a JOIN {name}{k} b ON a.j = b.i GROUP BY a.i, b.j),"
            f" {name}{k + 1} AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM {name}_{k} WHERE i = j) AS c FROM {name}_{k})"
        )
    last = f"{name}{squarings}"
    steps.append(
        f"{name}_top AS (SELECT i AS t, c AS d FROM {last} WHERE i = j ORDER BY c DESC, i LIMIT 1),"
        f" {name}_raw AS (SELECT i, c / sqrt(d) AS v FROM {last}, {name}_top WHERE j = t),"
        f" {name} AS MATERIALIZED (SELECT i, v / (SELECT sqrt(sum(v * v)) FROM {name}_raw) AS v FROM {name}_raw),"
        f" {name}_value AS MATERIALIZED (SELECT sum(a.v * c.c * b.v) AS value FROM {cov} c JOIN {name} a ON a.i = c.i JOIN {name} b ON b.i = c.j)"
    )
    return ",\n".join(steps)


def _sql_projection(axis: str) -> str:
    return " + ".join(f"({c} - (SELECT avg({c}) FROM tr)) * (SELECT v FROM {axis} WHERE i = {i})" for i, c in enumerate(FEATURES))


SQL_PCA = ",\n".join(
    [
        "cov AS MATERIALIZED (SELECT unnest(["
        + ", ".join(f"{{'i': {i}, 'j': {j}, 'c': covar_samp({a}, {b})}}" for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES))
        + "], recursive := true) FROM tr)",
        _sql_component("cov", "u"),
        "rest AS MATERIALIZED (SELECT c.i, c.j, c.c - value * a.v * b.v AS c FROM cov c JOIN u a ON a.i = c.i JOIN u b ON b.i = c.j, u_value)",
        _sql_component("rest", "w"),
        f"pcs AS MATERIALIZED (SELECT year, posteam, playoffs AS label, year IN ({_TEST_IN}) AS is_test,"
        f" {_sql_projection('u')} AS pc1, {_sql_projection('w')} AS pc2 FROM se)",
    ]
)


def _sql_newton(steps: int = 12) -> str:
    """CTEs for logistic regression on (pc1, pc2), C = 1: Newton steps, each 3 x 3 system by Cramer's rule; the weights are ``n{steps}``."""
    out = ["ptr AS (SELECT * FROM pcs WHERE NOT is_test)", "n0 AS (SELECT 0.0::DOUBLE AS b, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2)"]
    det = "({0} * ({4} * {8} - {5} * {7}) - {1} * ({3} * {8} - {5} * {6}) + {2} * ({3} * {7} - {4} * {6}))"
    h = ["h00", "h01", "h02", "h01", "h11", "h12", "h02", "h12", "h22"]

    def column(k: int) -> str:
        m = list(h)
        for r, g in enumerate(("g0", "g1", "g2")):
            m[3 * r + k] = g
        return det.format(*m)

    for k in range(steps):
        out.append(
            f"s{k} AS MATERIALIZED (SELECT any_value(b) AS b, any_value(w1) AS w1, any_value(w2) AS w2, sum(p - label) AS g0,"
            " sum((p - label) * pc1) + any_value(w1) AS g1, sum((p - label) * pc2) + any_value(w2) AS g2, sum(q) AS h00, sum(q * pc1) AS h01,"
            " sum(q * pc2) AS h02, sum(q * pc1 * pc1) + 1 AS h11, sum(q * pc1 * pc2) AS h12, sum(q * pc2 * pc2) + 1 AS h22"
            " FROM (SELECT *, p * (1 - p) AS q FROM (SELECT *, 1 / (1 + exp(-(b + w1 * pc1 + w2 * pc2))) AS p"
            f" FROM ptr CROSS JOIN n{k}))),"
            f" n{k + 1} AS MATERIALIZED (SELECT b - {column(0)} / {det.format(*h)} AS b, w1 - {column(1)} / {det.format(*h)} AS w1,"
            f" w2 - {column(2)} / {det.format(*h)} AS w2 FROM s{k})"
        )
    return ",\n".join(out)


SQL_LOGIT_PCA = ",\n".join(
    [
        SQL_SEASON_CTES,
        SQL_SPLIT,
        SQL_PCA,
        _sql_newton(),
        "lp AS (SELECT year, posteam, label, b + w1 * pc1 + w2 * pc2 AS z FROM pcs CROSS JOIN n12 WHERE is_test)",
    ]
)


def _sql_logistic(steps: int = 8) -> str:
    """CTEs for logistic regression on all features, C = 1: Newton steps on centred features, each system solved by
    Gauss-Jordan elimination, a CTE a column. ``wt{steps}`` (i, v) are the steps' sum; index 0 is the intercept."""
    d = len(FEATURES)
    out = [
        "ctr AS MATERIALIZED (SELECT year, posteam, playoffs AS label, [1.0::DOUBLE, "
        + ", ".join(f"{c} - (SELECT avg({c}) FROM tr)" for c in FEATURES)
        + "] AS x FROM tr)",
        f"wt0 AS MATERIALIZED (SELECT i, 0.0::DOUBLE AS v FROM range({d + 1}) t(i))",
    ]
    for k in range(steps):
        out.append(
            f"lz{k} AS MATERIALIZED (SELECT label, x, 1 / (1 + exp(-list_dot_product(x, (SELECT list(v ORDER BY i) FROM wt{k})))) AS p FROM ctr),"
            # the augmented system: columns 0..d are the Hessian, column d + 1 the gradient
            f" e{k}_0 AS MATERIALIZED (SELECT a.i, b.i AS j, sum(p * (1 - p) * x[a.i + 1] * x[b.i + 1]) + CASE WHEN a.i = b.i AND a.i > 0 THEN 1 ELSE 0 END AS v"
            f" FROM lz{k}, wt0 a, wt0 b GROUP BY a.i, b.i UNION ALL SELECT i, {d + 1}, sum((p - label) * x[i + 1]) + any_value(v) * CASE WHEN i > 0 THEN 1 ELSE 0 END"
            f" FROM lz{k}, wt{k} GROUP BY i)"
        )
        for c in range(d + 1):
            e = f"e{k}_{c}"
            out.append(
                f"e{k}_{c + 1} AS MATERIALIZED (SELECT a.i, a.j, CASE WHEN a.i = {c} THEN a.v / p.v ELSE a.v - f.v * r.v / p.v END AS v FROM {e} a"
                f" JOIN {e} f ON f.i = a.i AND f.j = {c} JOIN {e} r ON r.i = {c} AND r.j = a.j, (SELECT v FROM {e} WHERE i = {c} AND j = {c}) p)"
            )
        out.append(f"wt{k + 1} AS MATERIALIZED (SELECT w.i, w.v - e.v AS v FROM wt{k} w JOIN e{k}_{d + 1} e ON e.i = w.i AND e.j = {d + 1})")
    out.append(
        "lt AS (SELECT year, posteam, playoffs AS label, list_dot_product([1.0::DOUBLE, "
        + ", ".join(f"{c} - (SELECT avg({c}) FROM tr)" for c in FEATURES)
        + f"], (SELECT list(v ORDER BY i) FROM wt{steps})) AS z FROM te)"
    )
    return ",\n".join(out)


def _sql_tree(source: str = "se", features=FEATURES, label: str = "playoffs", t: str = "t", depth: int = 60) -> str:
    """CTEs for the tree grown to purity, one level a step; ``{t}v`` (year, posteam, label, p1) are the test rows' leaves."""
    cols = ", ".join(features)
    out = [
        f"{t}r0 AS MATERIALIZED (SELECT year, posteam, {label} AS label, year IN ({_TEST_IN}) AS is_test, CAST(0 AS HUGEINT) AS node, FALSE AS ended FROM {source})",
        f"{t}l AS MATERIALIZED (SELECT year, posteam, list_position([{_in_list(features)}], name) AS f, v FROM"
        f" (UNPIVOT (SELECT year, posteam, {cols} FROM {source}) ON {cols} INTO NAME name VALUE v))",
    ]
    for d in range(depth):
        r, c = f"{t}r{d}", f"{t}c{d}"
        out.append(
            f"{t}n{d} AS MATERIALIZED (SELECT node, CAST(count(*) AS DOUBLE) AS n, sum(label) AS p FROM {r} WHERE NOT is_test AND NOT ended GROUP BY node),"
            f" {t}s{d} AS MATERIALIZED (SELECT node, f, v, lead(v) OVER w AS later, sum(n) OVER w AS ln, sum(p) OVER w AS lp FROM (SELECT node, f, v,"
            f" CAST(count(*) AS DOUBLE) AS n, sum(label) AS p FROM {r} JOIN {t}l USING (year, posteam) WHERE NOT is_test AND NOT ended GROUP BY node, f, v)"
            " WINDOW w AS (PARTITION BY node, f ORDER BY v)),"
            f" {c} AS MATERIALIZED (SELECT node, f, v + (later - v) / 2 AS cut FROM (SELECT s.node, f, v, later, row_number() OVER (PARTITION BY s.node"
            f" ORDER BY lp * lp / ln + (p - lp) * (p - lp) / (n - ln) DESC, f, v) AS k FROM {t}s{d} s JOIN {t}n{d} g ON g.node = s.node"
            " WHERE later IS NOT NULL AND p > 0 AND p < n) WHERE k = 1),"
            f" {t}r{d + 1} AS MATERIALIZED (SELECT x.year, x.posteam, x.label, x.is_test, CASE WHEN x.ended OR c.node IS NULL THEN x.node"
            f" ELSE 2 * x.node + 1 + CAST(l.v > c.cut AS INTEGER) END AS node, x.ended OR c.node IS NULL AS ended FROM {r} x"
            f" LEFT JOIN {c} c ON c.node = x.node AND NOT x.ended LEFT JOIN {t}l l ON l.year = x.year AND l.posteam = x.posteam AND l.f = c.f)"
        )
    out.append(
        f"{t}f AS (SELECT node, avg(label) AS p1 FROM {t}r{depth} WHERE NOT is_test GROUP BY node),"
        f" {t}v AS MATERIALIZED (SELECT year, posteam, label, p1 FROM {t}r{depth} JOIN {t}f USING (node) WHERE is_test)"
    )
    return ",\n".join(out)


def _learner_out(scores: DataFrame) -> DataFrame:
    return scores.select(
        "model",
        F.col("model_ord").cast("bigint"),
        "year",
        F.col("posteam").cast("bigint"),
        "label",
        *_r(("p1", "margin")),
        "prediction",
    )


def _sql_learner_out(src: str, name: str, order: int, z: str = "z") -> str:
    return (
        f"SELECT '{name}' AS model, CAST({order} AS BIGINT) AS model_ord, year, CAST(posteam AS BIGINT) AS posteam, label,"
        f" {sql_round6(f'1 / (1 + exp(-({z})))')} AS p1, {sql_round6(z)} AS margin, CAST(CASE WHEN {z} > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM {src}"
    )


def _learner_query(kind: str, name: str, pca: bool = False):
    def q(spark, sf_dir):
        from .plans.leaderboard import FULL_NAMES, ORDER, PCA_NAMES
        from .plans.learners import Settings, fit_score
        from .schema import RBF_GAMMA_PCA

        train, test = split_seasons(spark, sf_dir)
        feats, s = FEATURES, Settings()
        if pca:
            train, test = component_seasons(train, test)
            feats, s = ("pc1", "pc2"), Settings(rbf_gamma=RBF_GAMMA_PCA)
        label = (PCA_NAMES if pca else FULL_NAMES)[kind]
        return _learner_out(fit_score(kind, train, test, feats, KEYS, label, ORDER[label], s))

    q.__name__ = f"q_{name}"
    return q


def component_seasons(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables on two principal components of the training rows, each written once."""
    from .plans.pca import fit_pca

    m = fit_pca(train, FEATURES, 2)
    keep = [*KEYS, "label"]
    return materialize(m.transform(train, keep), "pca-train"), materialize(m.transform(test, keep), "pca-test")


register("logistic", f"WITH {SQL_SEASON_CTES}, {SQL_SPLIT}, {_sql_logistic()} " + _sql_learner_out("lt", "logit", 1))(_learner_query("logit", "logistic"))
register(
    "cart",
    f"WITH {SQL_SEASON_CTES}, {_sql_tree()} SELECT 'CART' AS model, CAST(7 AS BIGINT) AS model_ord, year, CAST(posteam AS BIGINT) AS posteam, label,"
    f" {sql_round6('p1')} AS p1, {sql_round6('p1')} AS margin, CAST(CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM tv",
)(_learner_query("cart", "cart"))
for _kind, _name in (
    ("svm", "linear_svm"),
    ("kernel_svm", "kernel_svm_rff"),
    ("mlp", "mlp"),
    ("random_forest", "random_forest"),
    ("adaboost", "adaboost"),
    ("gbt", "gradient_boost"),
):
    register(_name)(_learner_query(_kind, _name))
register("logistic_pca", f"WITH {SQL_LOGIT_PCA} " + _sql_learner_out("lp", "Logit-PCA", 12))(_learner_query("logit", "logistic_pca", pca=True))
SQL_KNN_PCA = (
    "kd AS (SELECT q.year, q.posteam, q.label, t.label AS p1, row_number() OVER (PARTITION BY q.year, q.posteam"
    " ORDER BY (q.pc1 - t.pc1) * (q.pc1 - t.pc1) + (q.pc2 - t.pc2) * (q.pc2 - t.pc2), t.year, t.posteam) AS rn"
    " FROM pcs q CROSS JOIN pcs t WHERE q.is_test AND NOT t.is_test)"
)
register(
    "knn_pca",
    f"WITH {SQL_SEASON_CTES}, {SQL_SPLIT}, {SQL_PCA}, {SQL_KNN_PCA} SELECT 'KNN-PCA' AS model, CAST(13 AS BIGINT) AS model_ord, year,"
    " CAST(posteam AS BIGINT) AS posteam, label, p1, p1 AS margin, p1 AS prediction FROM kd WHERE rn = 1",
)(_learner_query("knn", "knn_pca", pca=True))


@register(
    "pca_2d",
    f"WITH {SQL_SEASON_CTES}, {SQL_SPLIT}, {SQL_PCA} SELECT year, CAST(posteam AS BIGINT) AS posteam, is_test,"
    f" {sql_round6('pc1')} AS pc1, {sql_round6('pc2')} AS pc2 FROM pcs",
)
def q_pca_2d(spark, sf_dir):
    """Two centred principal components of the training seasons, applied to all seasons."""
    from .plans.pca import fit_pca

    st = labelled_seasons(spark, sf_dir)
    m = fit_pca(st.filter(~F.col("is_test")), FEATURES, 2)
    return m.transform(st, ["year", F.col("posteam").cast("bigint").alias("posteam"), "is_test"]).select(
        "year", "posteam", "is_test", *_r(("pc1", "pc2"))
    )


def _sql_boosting(rounds: int = 2, depth: int = 3, rate: float = 0.1) -> str:
    """CTEs for the first rounds of boosting on exact cuts; the margins are ``bx{rounds}`` (year, posteam, is_test, label, z)."""
    cols = ", ".join(FEATURES)
    out = [
        f"br AS MATERIALIZED (SELECT year, posteam, playoffs AS label, year IN ({_TEST_IN}) AS is_test, {cols} FROM se)",
        f"bl AS MATERIALIZED (SELECT year, posteam, label, is_test, list_position([{_in_list(FEATURES)}], name) AS f, v"
        f" FROM (UNPIVOT br ON {cols} INTO NAME name VALUE v))",
        # the cut after a value lies midway to the next distinct value of the whole training table
        "be AS MATERIALIZED (SELECT f, v, v + (lead(v) OVER (PARTITION BY f ORDER BY v) - v) / 2 AS edge FROM"
        " (SELECT DISTINCT f, v FROM bl WHERE NOT is_test))",
        "bx0 AS MATERIALIZED (SELECT year, posteam, is_test, label, (SELECT ln(avg(label) / (1 - avg(label))) FROM br WHERE NOT is_test) AS z FROM br)",
    ]
    for r in range(rounds):
        out.append(f"bn{r}_0 AS MATERIALIZED (SELECT *, 0 AS node, label - 1 / (1 + exp(-z)) AS r, 1 / (1 + exp(-z)) * (1 - 1 / (1 + exp(-z))) AS h FROM bx{r})")
        for d in range(depth):
            n = f"bn{r}_{d}"
            out.append(
                f"bs{r}_{d} AS MATERIALIZED (SELECT node, f, v, sum(n) OVER w AS ln, sum(r) OVER w AS lr, sum(n) OVER g AS tn, sum(r) OVER g AS t_r FROM"
                f" (SELECT node, f, v, count(*) AS n, sum(r) AS r FROM {n} JOIN bl USING (year, posteam) WHERE NOT {n}.is_test GROUP BY node, f, v)"
                " WINDOW w AS (PARTITION BY node, f ORDER BY v), g AS (PARTITION BY node, f)),"
                f" bg{r}_{d} AS MATERIALIZED (SELECT node, f, edge, gain, max(gain) OVER (PARTITION BY node) AS top FROM (SELECT node, f, edge,"
                f" lr * lr / ln + (t_r - lr) * (t_r - lr) / (tn - ln) - t_r * t_r / tn AS gain FROM bs{r}_{d} JOIN be USING (f, v) WHERE ln < tn)),"
                f" bc{r}_{d} AS MATERIALIZED (SELECT node, f, edge FROM (SELECT node, f, edge, row_number() OVER (PARTITION BY node ORDER BY f, edge) AS k"
                f" FROM bg{r}_{d} WHERE top > 1e-12 AND gain >= top - abs(top) * 1e-12) WHERE k = 1),"
                # a node without a cut keeps its place below all later ones
                f" bn{r}_{d + 1} AS MATERIALIZED (SELECT x.year, x.posteam, x.is_test, x.label, x.z, CASE WHEN c.node IS NULL THEN -1000 - x.node"
                f" ELSE 2 * x.node + 1 + CAST(bl.v > c.edge AS INTEGER) END AS node, x.r, x.h FROM {n} x LEFT JOIN bc{r}_{d} c USING (node)"
                " LEFT JOIN bl ON bl.year = x.year AND bl.posteam = x.posteam AND bl.f = c.f)"
            )
        last = f"bn{r}_{depth}"
        out.append(
            f"bv{r} AS MATERIALIZED (SELECT node, sum(r) / sum(h) AS value FROM {last} WHERE NOT is_test GROUP BY node),"
            f" bx{r + 1} AS MATERIALIZED (SELECT year, posteam, is_test, label, z + {rate} * value AS z FROM {last} JOIN bv{r} USING (node))"
        )
    return ",\n".join(out)


@register(
    "gradient_boost_two_rounds",
    f"WITH {SQL_SEASON_CTES}, {_sql_boosting()}, bt AS (SELECT * FROM bx2 WHERE is_test) " + _sql_learner_out("bt", "Gradient Boosting", 10),
)
def q_gradient_boost_two_rounds(spark, sf_dir):
    """Boosting after two rounds of depth-3 trees with Newton leaves. The SQL has exact cuts, as the learner where a
    feature has at most ``gbt_bins`` distinct values; here as many as there are training rows."""
    from .plans.learners import Settings, fit_score

    train, test = split_seasons(spark, sf_dir)
    s = Settings(gbt_iters=2, gbt_bins=max(512, train.count() + 1))
    return _learner_out(fit_score("gbt", train, test, FEATURES, KEYS, "Gradient Boosting", 10, s))


@register("top_importances")
def q_top_importances(spark, sf_dir):
    """|weight| of the linear SVM and the logistic model, top 18 of 20 each."""
    from .operators.explain import coefficient_importances, top_importances
    from .plans.learners import fit_model

    train, _ = split_seasons(spark, sf_dir)
    out = None
    for kind, name in (("svm", "SVM"), ("logit", "logit")):
        m = fit_model(kind, train, FEATURES)
        imp = top_importances(coefficient_importances(spark, m.coefficients, FEATURES))
        imp = imp.select(F.lit(name).alias("model"), "feature", round6("importance").alias("importance"))
        out = imp if out is None else out.unionByName(imp)
    return out


# ---------------------------------------------------------------------------
# 5. All twenty models: board, winner, reports, curves
# ---------------------------------------------------------------------------

_BOARDS: dict[tuple, str] = {}


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table of all twenty models on the test seasons, written.

    Fitted once a session for each season table: the reports below are different views of the same fits. The
    table is known by its rows' count and hash, so changed input is fitted anew.
    """
    from .plans.leaderboard import run_models
    from .session import lasting_tables, scratch_path, written_tables

    st = labelled_seasons(spark, sf_dir)
    hashes = F.xxhash64(*[F.col(c) for c in st.columns])
    seen = st.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.shiftright(hashes, 8 * k) % 65521).alias(f"h{k}") for k in range(4)]).first()
    key = (spark.sparkContext.applicationId, *seen)
    if key not in _BOARDS:
        with lasting_tables(spark):
            path = scratch_path(spark, "model-scores")
            with written_tables(spark):
                run_models(st.filter(~F.col("is_test")), st.filter(F.col("is_test")), FEATURES, KEYS).write.parquet(path)
        _BOARDS[key] = path
    return spark.read.parquet(_BOARDS[key])


@register("margins")
def q_margins(spark, sf_dir):
    """ROC areas of the ranking margins of SVM, perceptron, boosting and logistic models."""
    from .operators.curves import auc

    return auc(_ranked(spark, sf_dir), score="margin").select("model", "model_ord", round6("auc").alias("auc"))


def _ranked(spark, sf_dir) -> DataFrame:
    return model_scores(spark, sf_dir).filter(F.col("model").isin("SVM", "Neural Net", "Gradient Boosting", "logit"))


@register("roc_points_margins")
def q_roc_points_margins(spark, sf_dir):
    """ROC curves of the same four models, by margin (probability for the perceptron)."""
    from .operators.curves import roc_points

    return roc_points(_ranked(spark, sf_dir), score="margin").select("model", "model_ord", "threshold", *_r(("fpr", "tpr")))


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    """All twenty models × nine cut-offs: 180 rows of accuracy."""
    from .operators.evaluate import threshold_sweep

    return threshold_sweep(model_scores(spark, sf_dir)).select("model", "model_ord", "threshold", round6("accuracy").alias("accuracy"))


@register("winner")
def q_winner(spark, sf_dir):
    """The best of the 180 rows: highest accuracy, then leaderboard order, then the lower cut-off."""
    from .operators.evaluate import best_overall, threshold_sweep

    b = best_overall(threshold_sweep(model_scores(spark, sf_dir)))
    return b.select("model", "model_ord", "threshold", round6("accuracy").alias("accuracy"), "accuracy_pct")


@register("all_reports_at_cutoffs")
def q_all_reports_at_cutoffs(spark, sf_dir):
    """Classification report of all twenty models, each at its chosen cut-off."""
    from .operators.evaluate import cutoff_table, report_at_cutoffs

    return _report_out(report_at_cutoffs(model_scores(spark, sf_dir), cutoff_table(spark)))


@register("all_prediction_reports")
def q_all_prediction_reports(spark, sf_dir):
    """Classification report of all twenty models' own decisions."""
    from .operators.evaluate import prediction_report

    return _report_out(prediction_report(model_scores(spark, sf_dir)))


@register("learners_on_signal")
def q_learners_on_signal(spark, sf_dir):
    """All ten learners on the embeddings fixture, whose label depends on its features: scores of the held-out fifth."""
    from .plans.leaderboard import run_models
    from .sources import EMBED_FEATURES, labelled_embeddings

    table = materialize(labelled_embeddings(spark, sf_dir), "signal")
    scores = run_models(table.filter("NOT is_test"), table.filter("is_test"), EMBED_FEATURES, ["vec_id"], with_pca=False, gammas=(2.0, 2.0))
    return scores.select("model", "model_ord", "vec_id", "label", *_r(("p1", "margin")), "prediction")


@register(
    "own_accuracy",
    f"WITH {SQL_EVAL_CTES}, {_SQL_PRED} SELECT model, CAST(model_ord AS BIGINT) AS model_ord,"
    f" {sql_round6('round_even((tp + tn) / n, 3) * 100')} AS accuracy_pct FROM pc",
)
def q_own_accuracy(spark, sf_dir):
    """Each model's own accuracy as the scripts print it: rounded to three places, as a percentage."""
    from .operators.evaluate import prediction_counts

    pc = prediction_counts(nb_knn_scores(spark, sf_dir))
    share = F.bround((F.col("tp") + F.col("tn")) / F.col("n"), 3) * 100
    return pc.select("model", F.col("model_ord").cast("bigint"), round6(share).alias("accuracy_pct"))


# The eight models that SQL can fit, together: sweep, reports, curves and winner as for all twenty.
_PC = ("pc1", "pc2")
SQL_NB_PCA = (
    "qcls AS (SELECT label AS c, count(*) AS nc, "
    + ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in _PC)
    + " FROM pcs WHERE NOT is_test GROUP BY label),"
    " qtot AS (SELECT count(*) AS n, 1e-9 * greatest(var_pop(pc1), var_pop(pc2)) AS eps FROM pcs WHERE NOT is_test),"
    " qj AS (SELECT p.year, p.posteam, p.label, q.c, ln(q.nc / n) - 0.5 * ("
    + " + ".join(f"ln(2 * pi() * (v_{c} + eps))" for c in _PC)
    + ") - 0.5 * ("
    + " + ".join(f"(p.{c} - m_{c}) * (p.{c} - m_{c}) / (v_{c} + eps)" for c in _PC)
    + ") AS j FROM pcs p CROSS JOIN qcls q CROSS JOIN qtot WHERE p.is_test),"
    " qnb AS (SELECT year, posteam, label, 1.0 / (1.0 + exp(max(CASE WHEN c = 0 THEN j END) - max(CASE WHEN c = 1 THEN j END))) AS p1"
    " FROM qj GROUP BY year, posteam, label)"
)
SQL_EIGHT = ",\n".join(
    [
        SQL_SEASON_CTES, SQL_SPLIT, SQL_NB, SQL_KNN, _sql_logistic(), _sql_tree(), SQL_PCA, _sql_newton(),
        "lp AS (SELECT year, posteam, label, b + w1 * pc1 + w2 * pc2 AS z FROM pcs CROSS JOIN n12 WHERE is_test)",
        SQL_KNN_PCA, SQL_NB_PCA, _sql_tree("pcs", _PC, "label", "u_"),
        # probabilities on the 2**-20 grid, as the queries have them: a cut-off never falls between two engines' last digits
        "sc AS MATERIALIZED (SELECT model, model_ord, year, posteam, label, " + sql_round6("p1") + " AS p1, prediction FROM ("
        + " UNION ALL ".join(
            f"SELECT '{m}' AS model, {o} AS model_ord, year, posteam, label, {p} AS p1, CAST(CASE WHEN {d} THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM {t}"
            for m, o, t, p, d in (
                ("logit", 1, "lt", "1 / (1 + exp(-z))", "z > 0"), ("naive bayes", 2, "nb", "p1", "p1 > 0.5"), ("KNN", 6, "kn", "p1", "p1 > 0.5"),
                ("CART", 7, "tv", "p1", "p1 > 0.5"), ("NB-PCA", 11, "qnb", "p1", "p1 > 0.5"), ("Logit-PCA", 12, "lp", "1 / (1 + exp(-z))", "z > 0"),
                ("KNN-PCA", 13, "(SELECT * FROM kd WHERE rn = 1)", "p1", "p1 > 0.5"), ("CART-PCA", 17, "u_v", "p1", "p1 > 0.5"),
            )
        )
        + "))",
        "scr AS (SELECT *, p1 AS score FROM sc)",
    ]
)
SQL_MODELS = ("logit", "naive bayes", "KNN", "CART", "NB-PCA", "Logit-PCA", "KNN-PCA", "CART-PCA")


def sql_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table of the eight models, fitted anew, with probabilities on the grid."""
    from functools import reduce

    from .plans.leaderboard import FULL_NAMES, ORDER, PCA_NAMES
    from .plans.learners import fit_score

    full = split_seasons(spark, sf_dir)
    both = component_seasons(*full)
    kinds = {n: (k, full, FEATURES) for k, n in FULL_NAMES.items()} | {n: (k, both, _PC) for k, n in PCA_NAMES.items()}
    parts = [fit_score(kinds[n][0], *kinds[n][1], kinds[n][2], KEYS, n, ORDER[n]) for n in SQL_MODELS]
    out = reduce(DataFrame.unionByName, parts)
    return materialize(out.withColumn("p1", round6("p1")).withColumn("score", F.col("p1")), "sql-model-scores")


@register(
    "leaderboard_sql_models",
    f"WITH {SQL_EIGHT}, {SQL_THRESHOLDS} SELECT model, CAST(model_ord AS BIGINT) AS model_ord, threshold, {_SQL_ACC} AS accuracy FROM cc",
)
def q_leaderboard_sql_models(spark, sf_dir):
    from .operators.evaluate import threshold_sweep

    lb = threshold_sweep(sql_model_scores(spark, sf_dir))
    return lb.select("model", F.col("model_ord").cast("bigint"), "threshold", round6("accuracy").alias("accuracy"))


@register("reports_sql_models", f"WITH {SQL_EIGHT}, {_SQL_CUT}, " + _sql_report("ccut"))
def q_reports_sql_models(spark, sf_dir):
    """Each of the eight models at its chosen cut-off."""
    from .operators.evaluate import cutoff_table, report_at_cutoffs

    return _report_out(report_at_cutoffs(sql_model_scores(spark, sf_dir), cutoff_table(spark)))


@register("prediction_reports_sql_models", f"WITH {SQL_EIGHT}, {_SQL_PRED}, " + _sql_report("pc"))
def q_prediction_reports_sql_models(spark, sf_dir):
    """Each of the eight models by its own decision."""
    from .operators.evaluate import prediction_report

    return _report_out(prediction_report(sql_model_scores(spark, sf_dir)))


@register(
    "winner_sql_models",
    f"WITH {SQL_EIGHT}, {SQL_THRESHOLDS}, {_SQL_LB} SELECT model, CAST(model_ord AS BIGINT) AS model_ord,"
    f" threshold, {sql_round6('accuracy')} AS accuracy, round_even(accuracy * 100.0, 2) AS accuracy_pct FROM lb"
    " ORDER BY lb.accuracy DESC, model_ord, threshold LIMIT 1",
)
def q_winner_sql_models(spark, sf_dir):
    from .operators.evaluate import best_overall, threshold_sweep

    b = best_overall(threshold_sweep(sql_model_scores(spark, sf_dir)))
    return b.select("model", F.col("model_ord").cast("bigint"), "threshold", round6("accuracy").alias("accuracy"), "accuracy_pct")


@register(
    "roc_points_sql_models",
    f"WITH {SQL_EIGHT}, {_SQL_ROC} SELECT model, CAST(model_ord AS BIGINT) AS model_ord, score AS threshold,"
    f" {sql_round6('CASE WHEN tn_all > 0 THEN cn / tn_all END')} AS fpr,"
    f" {sql_round6('CASE WHEN tp_all > 0 THEN cp / tp_all END')} AS tpr FROM rc"
    " WHERE k = 1 OR np_ IS NULL OR np_ <> pos OR nn_ <> neg"
    " UNION ALL SELECT model, CAST(model_ord AS BIGINT), NULL, CASE WHEN tn_all > 0 THEN 0.0 END,"
    " CASE WHEN tp_all > 0 THEN 0.0 END FROM rc WHERE k = 1",
)
def q_roc_points_sql_models(spark, sf_dir):
    from .operators.curves import roc_points

    r = roc_points(sql_model_scores(spark, sf_dir))
    return r.select("model", F.col("model_ord").cast("bigint"), "threshold", *_r(("fpr", "tpr")))


SQL_GRID_PCA = (
    "pgb AS (SELECT min(pc1) AS x0, max(pc1) AS x1, min(pc2) AS y0, max(pc2) AS y1 FROM pcs WHERE NOT is_test),"
    " pgn AS (SELECT x0, y0, CAST(ceil((x1 - x0) / 0.5) AS BIGINT) AS nx, CAST(ceil((y1 - y0) / 0.5) AS BIGINT) AS ny FROM pgb),"
    " pgx AS (SELECT x0 + CAST(unnest(range(nx)) AS DOUBLE) * 0.5 AS pc1 FROM pgn),"
    " pgy AS (SELECT y0 + CAST(unnest(range(ny)) AS DOUBLE) * 0.5 AS pc2 FROM pgn),"
    " pg AS MATERIALIZED (SELECT * FROM pgx CROSS JOIN pgy),"
    " pgj AS (SELECT pg.*, q.c, ln(q.nc / n) - 0.5 * ("
    + " + ".join(f"ln(2 * pi() * (v_{c} + eps))" for c in _PC)
    + ") - 0.5 * ("
    + " + ".join(f"(pg.{c} - m_{c}) * (pg.{c} - m_{c}) / (v_{c} + eps)" for c in _PC)
    + ") AS j FROM pg CROSS JOIN qcls q CROSS JOIN qtot),"
    " pgk AS (SELECT g.pc1, g.pc2, arg_min(t.label, {'d': (g.pc1 - t.pc1) * (g.pc1 - t.pc1) + (g.pc2 - t.pc2) * (g.pc2 - t.pc2),"
    " 'y': t.year, 'p': t.posteam}) AS y FROM pg g CROSS JOIN pcs t WHERE NOT t.is_test GROUP BY g.pc1, g.pc2),"
    " regions AS (SELECT 'NB-PCA' AS model, pc1, pc2, CASE WHEN max(CASE WHEN c = 1 THEN j END) > max(CASE WHEN c = 0 THEN j END) THEN 1 ELSE 0 END AS predicted"
    " FROM pgj GROUP BY pc1, pc2 UNION ALL SELECT 'Logit-PCA', pc1, pc2, CASE WHEN b + w1 * pc1 + w2 * pc2 > 0 THEN 1 ELSE 0 END FROM pg CROSS JOIN n12"
    " UNION ALL SELECT 'KNN-PCA', pc1, pc2, y FROM pgk)"
)


def component_grids(train: DataFrame, names) -> DataFrame:
    """(model, pc1, pc2, predicted) of two-component models over the mesh (step 0.5) spanning the projected training seasons."""
    from functools import reduce

    from .operators.explain import decision_grid
    from .plans.leaderboard import PCA_NAMES
    from .plans.learners import Settings, fit
    from .schema import RBF_GAMMA_PCA

    s = Settings(rbf_gamma=RBF_GAMMA_PCA)
    grids = []
    for kind, name in PCA_NAMES.items():
        if name in names:
            fitted = fit(kind, train, _PC, KEYS, s)
            grid = decision_grid(train, *_PC, lambda pts, f=fitted: f.score(pts, list(_PC)))
            grids.append(grid.select(F.lit(name).alias("model"), *_r(_PC), "predicted"))
    return reduce(DataFrame.unionByName, grids)


@register("decision_grid_pca")
def q_decision_grid_pca(spark, sf_dir):
    """Decision regions of all ten two-component models."""
    from .plans.leaderboard import PCA_NAMES

    return component_grids(component_seasons(*split_seasons(spark, sf_dir))[0], set(PCA_NAMES.values()))


@register(
    "decision_grid_sql_models",
    f"WITH {SQL_LOGIT_PCA}, {SQL_NB_PCA}, {SQL_GRID_PCA} SELECT model, {sql_round6('pc1')} AS pc1, {sql_round6('pc2')} AS pc2,"
    " CAST(predicted AS DOUBLE) AS predicted FROM regions",
)
def q_decision_grid_sql_models(spark, sf_dir):
    """The three of them that SQL can fit and score."""
    return component_grids(component_seasons(*split_seasons(spark, sf_dir))[0], {"NB-PCA", "Logit-PCA", "KNN-PCA"})


# ---------------------------------------------------------------------------
# 6. Cut-offs chosen on training seasons
# ---------------------------------------------------------------------------

SQL_VALIDATION = ",\n".join(
    [
        SQL_SEASON_CTES,
        SQL_SPLIT,
        "held AS (SELECT DISTINCT year AS held FROM tr)",
        "vc AS (SELECT held, playoffs AS c, count(*) AS nc, "
        + ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in _F)
        + " FROM tr JOIN held ON tr.year <> held GROUP BY held, playoffs)",
        "vt AS (SELECT held, count(*) AS n, 1e-9 * greatest("
        + ", ".join(f"var_pop({c})" for c in _F)
        + ") AS eps FROM tr JOIN held ON tr.year <> held GROUP BY held)",
        "vj AS (SELECT tr.year, tr.posteam, tr.playoffs AS label, vc.c, ln(vc.nc / vt.n) - 0.5 * ("
        + " + ".join(f"ln(2 * pi() * (v_{c} + eps))" for c in _F)
        + ") - 0.5 * ("
        + " + ".join(f"(tr.{c} - m_{c}) * (tr.{c} - m_{c}) / (v_{c} + eps)" for c in _F)
        + ") AS j FROM tr JOIN vc ON vc.held = tr.year JOIN vt ON vt.held = tr.year)",
        "vs AS (SELECT 'naive bayes' AS model, 2 AS model_ord, year, posteam, label, 1.0 / (1.0 + exp(max(CASE WHEN c = 0 THEN j END)"
        " - max(CASE WHEN c = 1 THEN j END))) AS p1 FROM vj GROUP BY year, posteam, label)",
    ]
)


@register(
    "season_out_scores",
    f"WITH {SQL_VALIDATION} SELECT year, CAST(posteam AS BIGINT) AS posteam, label, {sql_round6('p1')} AS p1 FROM vs",
)
def q_season_out_scores(spark, sf_dir):
    """Naive Bayes probabilities of each training season by a model of the other seasons, in one job."""
    from .plans.validation import naive_bayes_season_out

    train, _ = split_seasons(spark, sf_dir)
    scores = naive_bayes_season_out(train, FEATURES, KEYS)
    return scores.select("year", F.col("posteam").cast("bigint"), "label", round6("p1").alias("p1"))


@register(
    "validated_report",
    f"WITH {SQL_VALIDATION}, {SQL_NB}, vth AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES "
    + ", ".join(f"({t})" for t in THRESHOLDS)
    + ") v(t)), vb AS (SELECT threshold FROM (SELECT threshold, avg(CASE WHEN (p1 > threshold) = (label = 1) THEN 1.0 ELSE 0.0 END) AS acc"
    " FROM vs CROSS JOIN vth GROUP BY threshold) ORDER BY acc DESC, threshold LIMIT 1),"
    " vcc AS (SELECT 'naive bayes' AS model, 2 AS model_ord, vb.threshold,"
    " CAST(sum(CASE WHEN p1 > threshold AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,"
    " CAST(sum(CASE WHEN p1 > threshold AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,"
    " CAST(sum(CASE WHEN NOT p1 > threshold AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,"
    " CAST(sum(CASE WHEN NOT p1 > threshold AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,"
    " CAST(count(*) AS BIGINT) AS n FROM nb CROSS JOIN vb GROUP BY vb.threshold), "
    + _sql_report("vcc"),
)
def q_validated_report(spark, sf_dir):
    """Report on the test seasons at the cut-off that did best on training seasons left out one at a time."""
    from .plans.learners import fit_score
    from .plans.validation import naive_bayes_season_out, validated_report

    train, test = split_seasons(spark, sf_dir)
    validation = naive_bayes_season_out(train, FEATURES, KEYS)
    return _report_out(validated_report(validation, fit_score("naive_bayes", train, test, FEATURES, KEYS, "naive bayes", 2)))


__all__ = ["QUERIES", "ORACLE", "register", "season_table", "prepared_plays", "PLAY_KEYS"]
