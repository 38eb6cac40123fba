"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app: str = "riskstream", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the engine's settings; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Event times are epoch offsets, so every job reads and prints them in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session (tests, laptop) may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="riskstream-")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Scratch:
    """Tables that :func:`written` makes while this is open (``with``) belong to it.

    ``remove`` deletes them once nothing reads them any more. What is left when it closes goes to
    the one it was opened in, if any.
    """

    _open = threading.local()

    def __init__(self) -> None:
        self._paths: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> Scratch:
        self._stack().append(self)
        return self

    def __exit__(self, *_) -> None:
        stack = self._stack()
        stack.remove(self)
        if stack:
            stack[-1]._paths += self._paths
            self._paths = []

    def remove(self, but: DataFrame | None = None, *others: DataFrame) -> None:
        """Delete the tables that neither ``but`` nor one of the ``others`` reads."""
        read = [df for df in (but, *others) if df is not None] if self._paths else []
        needed = [file for df in read for file in df.inputFiles()]
        kept = []
        for spark, path in self._paths:
            if any(f"{path}/" in file for file in needed):
                kept.append((spark, path))
            else:
                _delete(spark, path)
        self._paths = kept

    @classmethod
    def _stack(cls) -> list[Scratch]:
        if not hasattr(cls._open, "stack"):
            cls._open.stack = []
        return cls._open.stack


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a write shuffles is deleted when it ends, not when the driver next collects garbage."""
    before = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FILE_CLEANUP)
        else:
            spark.conf.set(_FILE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    The result is computed once, survives lost executors, and carries its real
    size, so Spark broadcasts it in later joins only when it is small enough.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/riskstream/{name}-{uuid.uuid4().hex}"
    for scratch in Scratch._stack()[-1:]:
        scratch._paths.append((spark, path))
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(table: DataFrame) -> None:
    """Delete the files of a table that :func:`written` made and that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        _delete(table.sparkSession, folder)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The written table and its number of rows, counted while it is written."""
    seen = Observation()
    table = written(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return table, seen.get["n"]
