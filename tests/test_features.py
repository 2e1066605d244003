"""Hand-made edge cases for the play → game → season operators (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from seasonkit.operators import features as fe
from seasonkit.schema import GAME_MEAN_COLUMNS_VARIANT

COLS = (
    "year string, week int, game_id string, season_type string, home_team string, away_team string, "
    "posteam string, play_type string, field_goal_result string, epa double, pass double, rush double, "
    "yardline_100 double, yards_gained double, score_differential double, passing_yards double, "
    "rushing_yards double, penalty_yards double, cpoe double, first_down double, third_down_failed double, "
    "touchdown double, interception double, sack double, tackled_for_loss double, fumble double"
)


def play(year="2019", week=1, game="g1", st="REG", home="A", away="B", pos="A", pt="pass", fg=None, epa=0.1,
         ps=0.0, ru=0.0, yl=50.0, yg=5.0, sd=0.0, py=None, ry=None, pen=None, cpoe=None, fd=0.0, tdf=0.0,
         td=0.0, it=0.0, sk=0.0, tfl=0.0, fu=0.0):
    return (year, week, game, st, home, away, pos, pt, fg, epa, ps, ru, yl, yg, sd, py, ry, pen, cpoe, fd, tdf,
            td, it, sk, tfl, fu)


def test_filter_drops_null_epa_nan_epa_and_other_play_types(spark):
    df = spark.createDataFrame(
        [play(epa=None), play(epa=float("nan")), play(pt="kickoff"), play(pt=None), play(pt="punt")], COLS
    )
    out = fe.filter_plays(df).collect()
    assert len(out) == 1 and out[0]["play_type"] == "punt"


def test_relabel_pass_on_no_play_and_rush_wins(spark):
    df = spark.createDataFrame(
        [play(pt="no_play", ps=1.0, game="a"), play(pt="pass", ps=1.0, ru=1.0, game="b"), play(pt="punt", game="c")],
        COLS,
    )
    got = {r["game_id"]: r["play_type"] for r in fe.relabel_plays(fe.filter_plays(df)).collect()}
    assert got == {"a": "pass", "b": "run", "c": "punt"}


def test_flags_and_null_posteam(spark):
    df = spark.createDataFrame(
        [play(pos=None, home="A"), play(pos="A", home="A", fg="made"), play(pos="B", home="A", fg="missed")], COLS
    )
    rows = fe.derive_flags(df).select("posteam", "is_home_team", "fg_made", "fg_missed").collect()
    assert [tuple(r) for r in rows] == [(None, 0, 0, 0), ("A", 1, 1, 0), ("B", 0, 0, 1)]
    games = fe.game_features(fe.prepare_plays(df)).collect()
    assert all(r["posteam"] is not None for r in games)


def test_sum_of_all_missing_is_zero_but_mean_variant_is_null(spark):
    df = spark.createDataFrame([play(py=None, pt="run", ru=1.0), play(py=None, pt="run", ru=1.0)], COLS)
    p = fe.prepare_plays(df)
    s = fe.game_features(p).first()
    m = fe.game_features(p, mean_columns=GAME_MEAN_COLUMNS_VARIANT).first()
    assert s["passing_yards"] == 0.0 and m["passing_yards"] is None


def test_season_mean_skips_missing_game_values(spark):
    df = spark.createDataFrame([play(game="g1", week=1, cpoe=None), play(game="g2", week=2, cpoe=4.0)], COLS)
    se = fe.season_table(df).first()
    assert se["cpoe"] == pytest.approx(4.0)
    assert se["week"] == pytest.approx(1.5)


def test_playoff_label_is_per_season(spark):
    df = spark.createDataFrame(
        [
            play(year="2018", game="r18", pos="A"),
            play(year="2019", game="r19", pos="A"),
            play(year="2019", game="p19", st="POST", home="A", away="C", pos="C"),
        ],
        COLS,
    )
    got = {(r["year"], r["posteam"]): r["playoffs"] for r in fe.season_table(df).collect()}
    assert got == {("2018", "A"): 0.0, ("2019", "A"): 1.0}


def test_mean_of_games_differs_from_mean_of_plays(spark):
    rows = [play(game="g1", week=1, yl=10.0)] + [play(game="g2", week=2, yl=90.0) for _ in range(9)]
    df = spark.createDataFrame(rows, COLS)
    games = fe.season_table(df).first()["yardline_100"]
    direct = fe.season_features_direct(df).first()["yardline_100"]
    assert games == pytest.approx(50.0)
    assert direct == pytest.approx(82.0)


def test_drop_columns_is_strict(spark):
    df = spark.createDataFrame([play()], COLS)
    with pytest.raises(ValueError):
        fe.drop_columns(df, ["no_such_column"])


def test_post_teams_distinct_over_home_and_away(spark):
    df = spark.createDataFrame(
        [play(st="POST", home="A", away="B"), play(st="POST", home="B", away="A"), play(st="REG", home="C", away="D")],
        COLS,
    )
    got = sorted((r["year"], r["team"]) for r in fe.post_teams(df).collect())
    assert got == [("2019", "A"), ("2019", "B")]


def test_fill_missing_is_off_by_default(spark):
    df = spark.createDataFrame([play(cpoe=None)], COLS)
    assert fe.fill_missing(df).first()["cpoe"] is None
    assert fe.fill_missing(df, enabled=True).first()["cpoe"] == 0.0


def test_hot_team_with_a_third_of_all_plays(spark):
    """One team-season holding a third of the plays: same result as the others."""
    rows = []
    for g in range(30):  # hot team: 30 games × 20 plays
        rows += [play(game=f"h{g}", week=g % 17 + 1, pos="H", home="H", yl=float(g)) for _ in range(20)]
    for t in range(40):  # 40 teams × 3 games × 10 plays
        for g in range(3):
            rows += [play(game=f"t{t}g{g}", week=g + 1, pos=f"T{t}", home="X", yl=10.0) for _ in range(10)]
    df = spark.createDataFrame(rows, COLS)
    se = {r["posteam"]: r for r in fe.season_table(df).collect()}
    assert len(se) == 41
    assert se["H"]["yardline_100"] == pytest.approx(14.5)
    assert se["H"]["is_home_team"] == pytest.approx(1.0)
    assert se["T0"]["yards_gained"] == pytest.approx(50.0)
