"""Play-table sources and sinks.

* ``read_play_files``  -- many season files (CSV, gzip by suffix, or Parquet), one scan
  for each distinct header, season taken from the file name or from ``year=`` folders.
* ``plays_from_lineitem`` -- deterministic stand-in play table over the
  driver's ``lineitem`` (see FIXTURES.md section 2).
* ``write_seasons`` -- materialise a table partitioned by season.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DROPPED_PLAYER_COLUMNS, PLAY_CSV_SCHEMA, require_columns
from .headers import read_by_header

SEASON_FILE_PATTERN = r"play_by_play_(\d{4})"

# The texts that pandas reads as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_play_files(
    spark: SparkSession,
    paths: str | Iterable[str],
    fmt: str = "csv",
    schema=PLAY_CSV_SCHEMA,
    required: Iterable[str] = (),
) -> DataFrame:
    """Read every season, one scan for each distinct header; no per-season loop on the driver.

    CSV files are read with their header and columns are taken **by name**
    and cast to the declared types (a season file has hundreds of columns in
    an order that is not fixed and changes between seasons, see ``headers``);
    ``MISSING_TOKENS`` are missing, as pandas reads them. A header without a required
    column and a file name without a season fail; a player column that only some files have is null in the others.
    The CSV parser only parses the selected columns. The season comes from
    ``year=`` partition folders when present (filters on ``year`` then prune
    folders), else from the file name (``play_by_play_2019.csv.gz``) through
    the scan's file metadata.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "csv":
        scans = read_by_header(spark, paths)
        for raw in scans:
            require_columns(raw, required)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [typed_plays(raw, schema) for raw in scans])
    raw = spark.read.format(fmt).load(paths)
    require_columns(raw, required)
    return typed_plays(raw, schema, tokens=())


def typed_plays(raw: DataFrame, schema=PLAY_CSV_SCHEMA, file_col: str | None = None, tokens=MISSING_TOKENS) -> DataFrame:
    """Columns of ``schema`` taken by name and cast; ``year`` from ``year=``
    folders, else from the season in the file name (``file_col`` or the scan's
    file metadata). Texts in ``tokens`` become null; none for typed formats, so that
    their filters still reach the scan."""
    optional = set(DROPPED_PLAYER_COLUMNS)
    missing = [f.name for f in schema.fields if f.name not in raw.columns and f.name not in optional]
    if missing:
        raise ValueError(f"season files lack required columns: {missing}")
    is_text = dict(raw.dtypes)

    def present(name: str) -> F.Column:
        c = F.col(name)
        return F.when(~c.isin(*tokens), c) if tokens and is_text[name] == "string" else c

    cols = [present(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in raw.columns]
    if "year" in raw.columns:
        return raw.select(*cols, F.col("year").cast("string").alias("year"))
    path = F.col(file_col) if file_col else F.col("_metadata.file_path")
    season = F.regexp_extract(path, SEASON_FILE_PATTERN, 1)
    unnamed = F.raise_error(F.concat(F.lit("no season in the file name "), path)).cast("string")
    return raw.select(*cols, F.when(season != "", season).otherwise(unnamed).alias("year"))


def write_seasons(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a table partitioned by season (``year=`` folders)."""
    writer = df.write.mode(mode).partitionBy("year")
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "NA").option("compression", "gzip")
    writer.format(fmt).save(path)
    return path


# Stand-in play table: a "team" is a supplier, a "game" a supplier-month.
# The expressions are the fixture definition and must stay as written.
_PLAY_VIEW_EXPRS = (
    "CAST(year(l_shipdate) AS STRING) AS year",
    "month(l_shipdate) AS week",
    "concat(CAST(year(l_shipdate) AS STRING), '_', CAST(month(l_shipdate) AS STRING)) AS game_id",
    "l_suppkey AS posteam",
    "CASE WHEN (month(l_shipdate) + l_suppkey) % 2 = 0 THEN l_suppkey"
    " ELSE CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey - 1 ELSE l_suppkey + 1 END END AS home_team",
    "CASE WHEN (month(l_shipdate) + l_suppkey) % 2 = 0"
    " THEN CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey - 1 ELSE l_suppkey + 1 END ELSE l_suppkey END AS away_team",
    "CASE WHEN l_quantity = 50 AND l_discount >= 0.09 THEN 'POST' ELSE 'REG' END AS season_type",
    "CASE WHEN l_returnflag = 'R' THEN 'pass' WHEN l_returnflag = 'A' THEN 'run'"
    " WHEN l_linenumber = 1 THEN 'punt' WHEN l_linenumber = 2 THEN 'field_goal'"
    " WHEN l_linenumber = 3 THEN 'extra_point' WHEN l_linenumber = 4 THEN 'no_play'"
    " WHEN l_linenumber = 5 THEN 'kickoff' ELSE NULL END AS play_type",
    "CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE l_discount - l_tax END AS epa",
    "CASE WHEN l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linenumber = 4 AND l_quantity > 25)"
    " THEN 1 ELSE 0 END AS pass",
    "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS rush",
    "2 * l_quantity AS yardline_100",
    "l_quantity - 10 AS yards_gained",
    "l_partkey % 29 - 14 AS score_differential",
    "CASE WHEN l_returnflag = 'R' THEN l_quantity END AS passing_yards",
    "CASE WHEN l_returnflag = 'A' THEN l_quantity END AS rushing_yards",
    "CASE WHEN l_returnflag = 'N' AND l_linenumber = 4 THEN CAST(5 AS DOUBLE) END AS penalty_yards",
    "CASE WHEN l_returnflag = 'R' THEN l_discount * 100 - 5 END AS cpoe",
    "CASE WHEN l_returnflag = 'N' AND l_linenumber = 2"
    " THEN CASE WHEN l_tax < 0.05 THEN 'made' ELSE 'missed' END END AS field_goal_result",
    "CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END AS first_down",
    "CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS third_down_failed",
    "CASE WHEN l_quantity >= 48 THEN 1 ELSE 0 END AS touchdown",
    "CASE WHEN l_returnflag = 'R' AND l_tax >= 0.08 THEN 1 ELSE 0 END AS interception",
    "CASE WHEN l_returnflag = 'R' AND l_quantity <= 3 THEN 1 ELSE 0 END AS sack",
    "CASE WHEN l_returnflag = 'A' AND l_quantity <= 5 THEN 1 ELSE 0 END AS tackled_for_loss",
    "CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END AS fumble",
)

# The same view for DuckDB (oracle side).
PLAYS_VIEW_SQL_DUCKDB = "SELECT " + ",\n ".join(e.replace("AS STRING", "AS VARCHAR") for e in _PLAY_VIEW_EXPRS) + "\nFROM lineitem"


def plays_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in play table over ``lineitem`` (one row per line item)."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*_PLAY_VIEW_EXPRS)
