"""Session helpers: building a session and writing intermediate tables."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

_local_dirs: dict[str, str] = {}
#: Folders written since each open ``temporary_tables`` began, innermost last.
_open_scopes: list[list[str]] = []

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app_name: str = "rankloom", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="rankloom-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def writer(df: DataFrame, mode: str = "errorifexists", level: int = 3) -> DataFrameWriter:
    """Writer of a table that stays on shared disks while others are made; a higher level takes longer and less room."""
    return df.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", level)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written, not when the driver collects its garbage.

    Only for writes of frames that are planned anew when used again, so not for those that a cached plan holds.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, path: str, mode: str = "errorifexists", level: int = 3) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    spark = df.sparkSession
    with shuffles_dropped(spark):
        writer(df, mode, level).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_table(spark: SparkSession, name: str, kept: bool = False) -> str:
    """Path of a table that ``temporary_tables`` around it removes, or if it is ``kept`` the one around that."""
    path = scratch_path(spark, name)
    for scope in _open_scopes[-2:-1] if kept else _open_scopes[-1:]:
        scope.append(path)
    return path


def materialise(df: DataFrame, name: str, kept: bool = False, level: int = 3) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later stages restart from these files when executors are lost, and the optimizer sees the
    real size of the table. Files are columnar, so readers stay pruned.
    """
    return written(df, scratch_table(df.sparkSession, name, kept), level=level)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are removed at the end, but for those kept; nothing lazy may hang on them then."""
    scope: list[str] = []
    _open_scopes.append(scope)
    try:
        yield
    finally:
        _open_scopes.pop()
        for path in scope:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


class AlternatingTable:
    """Table of an iterative job, rewritten each round in one of two folders.

    A round reads the folder its predecessor wrote while it fills the other one, so storage
    stays at two rounds however long the loop runs.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = scratch_table(spark, name)
        self._paths = itertools.cycle([f"{base}/a", f"{base}/b"])

    def write(self, df: DataFrame) -> DataFrame:
        return written(df, next(self._paths), "overwrite")
