"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given Parquet table, read by Spark alone (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, with the shuffle files of the write removed when it is done.

    The written table stands for them from then on. Otherwise they stay until the driver
    collects its garbage, and a loop of written slices fills the disk.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def boxed(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``df``, and every row as it came in the struct ``_row``.

    Names that an operator adds cannot clash with other columns of the input.
    """
    return df.select(*columns, F.struct("*").alias("_row"))


def unboxed(df: DataFrame, **changed: Column) -> DataFrame:
    """The rows of ``boxed`` again, some columns changed."""
    names = df.schema["_row"].dataType.names
    return df.select(*[changed[c].alias(c) if c in changed else F.col("_row").getField(c).alias(c) for c in names])


def small_side(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Broadcast ``df`` only when its counted ``rows`` are at most ``most``.

    Beyond it the join shuffles, and adaptive execution splits skewed keys.
    """
    return F.broadcast(df) if rows <= most else df


def replace_spans(text: Column, spans: Column) -> Column:
    """``text`` with each span (start, end, mark; code points, end exclusive) replaced by its mark.

    ``spans`` must be sorted by start; of overlapping spans the first one's mark stands for all.
    """

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], kept, s["mark"])).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
