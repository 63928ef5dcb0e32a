"""Session settings and the shared scratch area."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def spark_session(app: str = "skyfact", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and UTC dates; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On one machine the session's warehouse serves where the setting is missing; on a cluster a folder
    of one machine would lose rows, so there a missing setting is an error.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one."""
    return f"{scratch_root(spark)}/skyfact-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application stored; tables read from there are gone with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write shuffles leaves the executors' disks when the write ends, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP_CONF, None)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_CONF)
        else:
            spark.conf.set(_CLEANUP_CONF, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and hands Catalyst a real
    size, so that it can decide about broadcasts itself.
    """
    return materialize_parts([df], label)


@contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As ``materialize``, for a table that only the block reads: it is deleted at its end."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    try:
        yield _written([df], path)
    finally:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialize_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """One table of several frames with the same columns, written one after the other: what one of them shuffles
    is gone before the next begins."""
    first = next(parts := iter(parts))
    return _written(chain([first], parts), f"{scratch_dir(first.sparkSession)}/{label}-{uuid.uuid4().hex}")


def _written(parts: Iterable[DataFrame], path: str) -> DataFrame:
    for df in parts:
        with shuffles_dropped(df.sparkSession):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
