"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Options that matter at scale; the adaptive planner picks partition counts,
# turns small shuffled sides into broadcasts and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.ignoreMissingFiles": "true",
}


def build_session(app: str = "revloom", master: str | None = None, **conf) -> SparkSession:
    """Session with the library's defaults; keyword keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Folder a local session without spark.checkpoint.dir made for itself, by application.
_local_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table in the shared folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session, where driver and executors share one disk, may do without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="revloom-")
        base = _local_folders[app]
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if getattr(_short_lived, "paths", None) is not None:
        _short_lived.paths.append(path)
    return path


# Paths given out in this thread's innermost ``short_lived`` block.
_short_lived = threading.local()


@contextmanager
def short_lived(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made in the block when it ends. Nothing made of
    them may be read later: results must have been written to other places by then."""
    outer, _short_lived.paths = getattr(_short_lived, "paths", None), []
    try:
        yield
    finally:
        paths, _short_lived.paths = _short_lived.paths, outer
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan of a few small files as many tasks as there are cores.

    A scan that has enough splits, as any large table does, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


# Bytes of a row group of texts that are worked on after they are read.
ROW_GROUP = 8 << 20


def written(df: DataFrame, name: str, folders: list[str] | None = None, row_group: int | None = None) -> DataFrame:
    """Cut the lineage of ``df``: write it as Parquet to the shared folder and
    read it back. It survives lost executors and keeps column pruning. ``folders``
    are columns by whose values the files are kept apart, the last ones of ``df``.
    ``row_group`` is the size of what can be read apart: rows that lie unevenly in the
    files, as after a window over pages, are then dealt out evenly to the tasks."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("parquet.block.size", row_group) if row_group else df.write
    (writer.partitionBy(*folders) if folders else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
