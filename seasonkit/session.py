"""Session helpers: a local session for tests/bench, and the shared folder
used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from functools import wraps

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    # independent model fits run as concurrent jobs: share executors fairly so
    # short iterative jobs do not queue behind long stages of other fits
    "spark.scheduler.mode": "FAIR",
}


def local_session(cpus: int | str = "*", app: str = "seasonkit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster the folder is named by the cluster in ``spark.checkpoint.dir``
    (a distributed file system path) and is used as is. Only a local-mode
    session without the setting (tests) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster must name a shared folder for lineage cuts"
        )
    folder = tempfile.mkdtemp(prefix="seasonkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


class WrittenTables:
    """The written tables of one piece of work, and their end.

    ``release(result)`` removes every folder and catalogue table that the plan of ``result`` does not read; what
    it does read is left to the enclosing scope, in the end to the session's.
    """

    def __init__(self, spark: SparkSession, outer: WrittenTables | None = None):
        self.spark, self.outer = spark, outer
        self.folders: list[str] = []
        self.tables: list[str] = []

    def release(self, result: DataFrame | None = None) -> None:
        read = "\n".join(result.inputFiles()) if result is not None and (self.folders or self.tables) else ""
        left = WrittenTables(self.spark)
        for path in self.folders:
            # names end in a random number of their own, so a substring settles it however the path is spelled
            if os.path.basename(path) in read:
                left.folders.append(path)
            else:
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        for table in self.tables:
            if table.lower() in read.lower():
                left.tables.append(table)
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        owner = self.outer or _of_session(self.spark)
        if owner is not self:
            owner.folders += left.folders
            owner.tables += left.tables
        self.folders, self.tables = [], []


_CURRENT: ContextVar[WrittenTables | None] = ContextVar("written_tables", default=None)
_SESSIONS: dict[str, WrittenTables] = {}


def _of_session(spark: SparkSession) -> WrittenTables:
    """What outlives every scope: results still to be read; removed when Python ends, if the session lives."""
    app = spark.sparkContext.applicationId
    if app not in _SESSIONS:
        _SESSIONS[app] = WrittenTables(spark)

        def end() -> None:
            with suppress(Py4JError, OSError):  # the session may have ended already
                if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
                    _SESSIONS[app].release()

        atexit.register(end)
    return _SESSIONS[app]


@contextmanager
def written_tables(spark: SparkSession) -> Iterator[WrittenTables]:
    """A scope that owns the tables written inside it. At its end it removes all of them that are left, so a result that
    is to be read later must be handed to ``release`` (or be returned by a function under ``owns_tables``)."""
    scope = WrittenTables(spark, _CURRENT.get())
    token = _CURRENT.set(scope)
    try:
        yield scope
    finally:
        _CURRENT.reset(token)
        scope.release()


@contextmanager
def lasting_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside belong to the session, not to the scope around."""
    token = _CURRENT.set(None)
    try:
        yield
    finally:
        _CURRENT.reset(token)


def owns_tables(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For ``fn(spark, ...) -> DataFrame``: of the tables it writes, only those that its result reads are left."""

    @wraps(fn)
    def run(spark: SparkSession, *args, **kw) -> DataFrame:
        with written_tables(spark) as scope:
            result = fn(spark, *args, **kw)
            scope.release(result)
        return result

    return run


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder, owned by the scope that it is asked in."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    (_CURRENT.get() or _of_session(spark)).folders.append(path)
    return path


def own_table(spark: SparkSession, name: str) -> str:
    """``name``, a catalogue table about to be written, owned like a folder."""
    (_CURRENT.get() or _of_session(spark)).tables.append(name)
    return name


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but computes the plan only once (a
    reliable checkpoint of an unpersisted plan computes it twice), survives
    executor loss, and the re-read table gets column pruning and size
    statistics for the planner. The table ends with the scope it was written in (``written_tables``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
