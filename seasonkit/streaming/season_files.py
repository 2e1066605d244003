"""Incremental season ingest with Structured Streaming.

The reference processes season files one at a time in a loop (one file per
season). Here a file stream picks up season files as they land -- at most
``files_per_batch`` per micro-batch; the stream itself reads only their names, so that
seasons with unlike headers need no common schema -- and ``foreachBatch`` runs the same
batch operators on them: scans by header, filtered plays → labelled team-game table →
team-season table. Both results are written partitioned by ``year`` with
dynamic partition overwrite, so only the seasons present in the batch are
replaced: replaying an epoch after a failure rewrites the same partitions
(idempotent), and the stream's checkpoint records which files were done.

A season must arrive as one file (the post-season label needs the season's
post-season games); that is the layout of the published files. A season whose
games came from another batch already, or from two files, fails the stream: it
would otherwise replace the earlier file's games.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import features as fe
from ..sources.headers import escape_glob
from ..sources.plays import SEASON_FILE_PATTERN, read_play_files


def header_schema(spark: SparkSession, sample_file: str) -> T.StructType:
    """All-string schema of one season file's header, for streams that hold every file to it."""
    header = spark.read.option("header", True).csv(sample_file).columns
    return T.StructType([T.StructField(c, T.StringType()) for c in header])


def _guard_seasons(files: DataFrame, out_dir: str) -> None:
    """Note which file each season came from; fail where a season has two (one row per season)."""
    spark = files.sparkSession
    noted = f"{out_dir}/season_files"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(noted)
    known = files
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        known = files.unionByName(spark.read.schema("year string, _file string").parquet(noted))
    split = known.groupBy("year").agg(F.countDistinct("_file").alias("n")).filter("n > 1").limit(5).collect()
    if split:
        raise ValueError(f"seasons in more than one file: {sorted(r['year'] for r in split)}")
    files.write.mode("append").parquet(noted)


def _write_batch(out_dir: str, required: Sequence[str]):
    def run(batch: DataFrame, epoch_id: int) -> None:
        season = F.regexp_extract("_file", SEASON_FILE_PATTERN, 1)
        _guard_seasons(batch.select(season.alias("year"), "_file"), out_dir)
        files = [escape_glob(r["_file"]) for r in batch.collect()]  # names of at most ``files_per_batch`` files
        if not files:
            return
        plays = fe.prepare_plays(read_play_files(batch.sparkSession, files, required=required))
        games = fe.game_table(plays, prepared=True)
        seasons = fe.season_features(games)
        for name, df in (("games", games), ("seasons", seasons)):
            (
                df.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("year")
                .parquet(f"{out_dir}/{name}")
            )

    return run


def ingest_seasons(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    schema: T.StructType | None = None,
    files_per_batch: int = 1,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes every file present and stops.

    Files need not agree on their header. With ``schema``, a file that lacks one of its columns fails.
    """
    stream = (
        spark.readStream.format("binaryFile")  # the contents are not read: only the path is selected
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source_dir)
        .select(F.col("path").alias("_file"))
    )
    writer = stream.writeStream.foreachBatch(_write_batch(out_dir, schema.names if schema is not None else ())).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
