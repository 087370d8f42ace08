"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this package is designed for. AQE coalesces a generous
# initial partition count and splits the partition of a hot join key, also where that
# costs one more shuffle after the join.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    app_name: str = "matchmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the package defaults; the master is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="matchmill-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by the cluster in spark.checkpoint.dir.

    A machine-local folder is only ever used by a local master without that setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def _scratch_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/matchmill/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{_scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder; no frame made before works after."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is shuffled by a statement in here goes from the disks as it ends, not when the driver collects garbage."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before) if before else spark.conf.unset(_FREED)


def discard(*cut: DataFrame) -> None:
    """Remove the files of tables that ``cut_lineage`` has made, when nothing reads them any more."""
    for df in cut:
        spark = df.sparkSession
        path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = path_of(folder)
            if path_of(_scratch_dir(spark)).toUri().getPath() == path.getParent().toUri().getPath():
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike cached blocks the files outlive a lost executor, and unlike an RDD checkpoint
    they are columnar, so each later pass reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
