"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_made: list[str] = []
_roots: dict[str, str] = {}  # of local sessions without a shared folder, by application


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without one: on a cluster a machine-local folder would be
    lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{root} is a folder of one machine; executors can't share it")
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _roots:
        _roots[application] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _roots[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    _made.append(f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at its end, the scratch paths handed out inside: results must be written by then."""
    first = len(_made)
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _made[first:]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        del _made[first:]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings of the jobs that run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write a frame out and read it back: stable input for several consumers.

    Unlike a cache the written table outlives lost executors, and Spark knows its size
    when it picks the join strategy downstream.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
