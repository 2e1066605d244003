"""Header catalogue of CSV files: which files share which header.

Season files of different years need not agree on the order or the number of their columns, and one CSV
scan has one header. So the first line of each file is read in a task of its own, files are grouped by that
line, and each distinct header gets one scan; columns are then taken by name and the scans united. The driver
sees one short row a header with its file names, never any data. A scan of thousands of seasons costs as many
scans as there are distinct headers, not files.

A first-line task stops after one row: a compressed file is not read to its end. An empty file has no header and no
rows, so it is left out. File names with glob characters are escaped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Larger than any file: with it as the cost of opening a file, each file is one split in a partition of its own.
_WHOLE_FILE = str(1 << 44)


@contextmanager
def _set(spark: SparkSession, **conf: str):
    """Session settings for the time of a block."""
    names = {k: k.replace("__", ".") for k in conf}
    before = {n: spark.conf.get(n) for n in names.values()}
    try:
        for k, v in conf.items():
            spark.conf.set(names[k], v)
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def file_headers(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """(file, header): the first line of every file that isn't empty; ``file`` as the scan names it (URL-encoded).

    One small row a file; listed by the driver, as every scan's files are.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    with _set(spark, spark__sql__files__maxPartitionBytes=_WHOLE_FILE, spark__sql__files__openCostInBytes=_WHOLE_FILE):
        lines = spark.read.option("recursiveFileLookup", True).text(paths)
        named = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"))
        rows = named.mapInArrow(_first_row, "file string, header string").collect()  # splits are made while the settings hold
    return spark.createDataFrame(rows, "file string, header string")


def escape_glob(path: str) -> str:
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _root(path: str) -> str | None:
    """The folder above the first ``name=value`` folder, None where there is none."""
    found = re.search(r"/[^/=]+=[^/]*/", path)
    return path[: found.start()] if found else None


def read_by_header(spark: SparkSession, paths: str | Iterable[str]) -> list[DataFrame]:
    """One scan (all columns text) for each distinct header of the files, ``name=value`` folders as columns."""
    groups: dict[tuple[str, str | None], list[str]] = {}
    by_header = file_headers(spark, paths).groupBy("header").agg(F.collect_list("file").alias("files"))
    for row in by_header.collect():
        for path in map(unquote, row["files"]):
            groups.setdefault((row["header"], _root(path)), []).append(path)
    if not groups:
        raise ValueError(f"no season file has a header: {paths}")
    scans = []
    for (_, root), files in sorted(groups.items(), key=lambda g: min(g[1])):
        reader = spark.read.option("header", True).option("enforceSchema", False)
        if root is not None:
            reader = reader.option("basePath", escape_glob(root))
        scans.append(reader.csv([escape_glob(f) for f in sorted(files)]))
    return scans
