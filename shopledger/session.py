"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "shopledger", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library expects; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, whose tasks share one machine, may do without: it gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root
    if not spark.sparkContext.getCheckpointDir():
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shopledger-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, reachable from every executor."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Letters of surrogate keys and the digits of file names shrink far more than with the default.
COMPRESSION = "zstd"
_freeing: Counter = Counter()
_before: dict[str, str] = {}
_lock = Lock()


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Runs that start inside give their shuffle files back when they end.

    Otherwise the files of every run stay until the driver happens to collect its garbage, and a job
    of many runs needs the disk of all of them. Streams that start inside do the same.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _freeing[session]:
            _before[session] = spark.conf.get(FREED)
            spark.conf.set(FREED, "true")
        _freeing[session] += 1
    try:
        yield
    finally:
        with _lock:
            _freeing[session] -= 1
            if not _freeing[session]:
                spark.conf.set(FREED, _before.pop(session))


@contextmanager
def stored_once(df: DataFrame) -> Iterator[DataFrame]:
    """The rows of ``df`` for several uses, written in compressed columns and removed afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, "once")
    with freeing(spark):
        df.write.option("compression", COMPRESSION).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that a lost executor does not change the rows."""
    checkpoint_root(df.sparkSession)
    with freeing(df.sparkSession):
        return df.checkpoint()


def moment(as_of: datetime | str | None) -> Column:
    """``as_of`` as a timestamp column, or the current time when it is not given."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
