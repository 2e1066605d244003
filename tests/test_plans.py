"""Physical-plan checks: no cross products anywhere; pruned, filtered scans."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_cross_product_in_plan(spark, name):
    plan = plan_of(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_season_scan_is_pruned_and_filtered(spark):
    plan = plan_of(E.queries()["season_features"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan
    for s in schemas:
        # lineitem columns the play view never reads stay unread
        assert "l_orderkey" not in s and "l_extendedprice" not in s and "l_linestatus" not in s
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan
    # the team-game aggregate is partial before its exchange
    assert plan.count("HashAggregate") >= 4


def test_test_season_read_prunes_partitions(spark):
    from seasonkit.catalog import test_seasons_written

    plan = plan_of(test_seasons_written(spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[.*year", plan), plan


def test_season_filters_reach_a_parquet_scan(spark, tmp_path):
    """Play type, season type and season are filtered in the scan, and only the columns in use are read."""
    from pyspark.sql import functions as F

    from seasonkit.operators import features as fe
    from seasonkit.schema import PLAY_CSV_SCHEMA
    from seasonkit.sources import plays_from_lineitem, read_play_files

    plays = plays_from_lineitem(spark, SF_SMALL)
    typed = [plays[f.name].cast(f.dataType).alias(f.name) for f in PLAY_CSV_SCHEMA.fields if f.name in plays.columns]
    plays.select("year", *typed).withColumn("unused", F.lit(1)).write.partitionBy("year").parquet(str(tmp_path / "plays"))
    back = read_play_files(spark, str(tmp_path / "plays"), fmt="parquet")
    games = fe.game_features(fe.prepare_plays(back.filter("year IN ('1999', '2000')")))
    plan = plan_of(games)
    assert re.search(r"PushedFilters: .*In\(play_type, \[", plan), plan
    assert re.search(r"PushedFilters: .*EqualTo\(season_type,REG\)", plan), plan
    assert re.search(r"PartitionFilters: .*year", plan), plan
    assert "unused" not in plan and games.count() > 0
