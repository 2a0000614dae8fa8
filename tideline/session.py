"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(name: str = "tideline", **conf: str) -> SparkSession:
    """Session with the settings results depend on; cluster sizing is left to the caller.

    Adaptive execution, skew-join splitting and partition coalescing are Spark defaults
    and stay on.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Scratch folders of sessions that name none, by application.
_private: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder the cluster names; a private one only where none is named, as in tests.

    A private folder serves a local session alone: on a cluster the tables written there would
    be out of the executors' reach, so that is refused.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _private:
        _private[context.applicationId] = tempfile.mkdtemp(prefix="tideline-")
    return _private[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/tideline/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As :func:`materialise`, for a table that is needed only inside the ``with`` block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table below the scratch folder; no other path is touched."""
    if not path.startswith(f"{scratch_root(spark)}/tideline/"):
        raise ValueError(f"not a scratch table: {path}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)
