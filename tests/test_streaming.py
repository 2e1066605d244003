"""The season-file stream gives the same season table as the batch scan."""

import os

import pytest

from seasonkit.operators import features as fe
from seasonkit.sources import plays_from_lineitem, read_play_files
from seasonkit.streaming import header_schema, ingest_seasons

from .conftest import SF_SMALL


def test_stream_equals_batch(spark, tmp_path):
    src = os.path.join(tmp_path, "src")
    os.makedirs(src)
    plays = plays_from_lineitem(spark, SF_SMALL).toPandas()
    for year, part in plays.groupby("year"):
        part.drop(columns=["year"]).to_csv(
            os.path.join(src, f"play_by_play_{year}.csv.gz"), index=False, na_rep="NA", compression="gzip"
        )
    files = sorted(os.listdir(src))
    schema = header_schema(spark, os.path.join(src, files[0]))
    q = ingest_seasons(spark, src, os.path.join(tmp_path, "out"), os.path.join(tmp_path, "ckpt"), schema, 2)
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(os.path.join(tmp_path, "out", "seasons"))
    want = fe.season_table(read_play_files(spark, src))
    cols = ["year", "posteam", "epa", "yardline_100", "playoffs", "week"]
    g = sorted(tuple(r) for r in got.selectExpr("CAST(year AS STRING) AS year", *cols[1:]).collect())
    w = sorted(tuple(r) for r in want.select(*cols).collect())
    assert len(g) == len(w) == 70
    for a, b in zip(g, w):
        assert a[:2] == b[:2]
        assert a[2:] == pytest.approx(b[2:])


def test_season_in_two_files_fails(spark, tmp_path):
    src = os.path.join(tmp_path, "src")
    os.makedirs(src)
    plays = plays_from_lineitem(spark, SF_SMALL).filter("year = '1996'").toPandas().drop(columns=["year"])
    for part, name in ((plays.iloc[::2], "play_by_play_1996.csv.gz"), (plays.iloc[1::2], "play_by_play_1996_b.csv.gz")):
        part.to_csv(os.path.join(src, name), index=False, na_rep="NA", compression="gzip")
    schema = header_schema(spark, os.path.join(src, "play_by_play_1996.csv.gz"))
    q = ingest_seasons(spark, src, os.path.join(tmp_path, "out"), os.path.join(tmp_path, "ckpt"), schema, 1)
    with pytest.raises(Exception, match="more than one file"):
        q.awaitTermination(300)


def test_stream_of_unlike_headers(spark, tmp_path):
    """Each season in a column order of its own, one with an extra column; no schema is given."""
    src = os.path.join(tmp_path, "src")
    os.makedirs(src)
    plays = plays_from_lineitem(spark, SF_SMALL).filter("year <= '1998'").toPandas()
    for k, (year, part) in enumerate(plays.groupby("year")):
        part = part.drop(columns=["year"])
        part = part[[*part.columns[k:], *part.columns[:k]]].assign(**({"extra": 1} if k == 2 else {}))
        part.to_csv(os.path.join(src, f"play_by_play_{year}.csv.gz"), index=False, na_rep="NA", compression="gzip")
    q = ingest_seasons(spark, src, os.path.join(tmp_path, "out"), os.path.join(tmp_path, "ckpt"), files_per_batch=2)
    q.awaitTermination(300)
    assert q.exception() is None
    cols = ["year", "posteam", "epa", "yardline_100", "playoffs", "week"]
    got = spark.read.parquet(os.path.join(tmp_path, "out", "seasons")).selectExpr("CAST(year AS STRING) AS year", *cols[1:])
    want = fe.season_table(plays_from_lineitem(spark, SF_SMALL).filter("year <= '1998'")).selectExpr("year", "CAST(posteam AS STRING) AS posteam", *cols[2:])
    rows = lambda df: sorted((r[0], r[1], *(round(x, 9) for x in r[2:])) for r in df.collect())
    assert rows(got) == rows(want) and len(rows(got)) == 40
