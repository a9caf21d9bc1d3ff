"""Tables written to the cluster's shared folder, to cut lineage and to give
Catalyst real sizes.

A step that several later steps read, or that an iteration builds on, is written
as Parquet under ``spark.checkpoint.dir`` and read back. An executor that is lost
takes nothing with it, and the planner sees the file sizes, so that only tables
below ``spark.sql.autoBroadcastJoinThreshold`` are broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def step(spark: SparkSession) -> Iterator[list[str]]:
    """Delete all that is written to scratch inside the block, but for the folders whose
    paths are put into the list: for steps whose result is itself written."""
    made, keep = [], []
    token = _made.set(made)
    try:
        yield keep
    finally:
        _made.reset(token)
        outer = _made.get()
        for path in made:
            if path not in keep:
                remove(spark, path)
            elif outer is not None:
                outer.append(path)


def root(spark: SparkSession) -> str:
    """The shared folder; one is made only on a local master that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lumbre-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/lumbre-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name, removed when the application ends."""
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def save(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` and return it as read from its files.

    ``compact`` is for tables that are small beside the input, though many tasks make them:
    they are gathered into two files a core, as thousands of small files cost more to make,
    list and open than the rows to move.
    """
    if compact:
        df = df.repartition(2 * max(1, df.sparkSession.sparkContext.defaultParallelism))
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def path_of(df: DataFrame) -> str:
    """Where ``save`` wrote what it returned."""
    return df._scratch


def discard(df: DataFrame) -> None:
    """Delete what ``save`` wrote for ``df``, once nothing reads it any more."""
    path = getattr(df, "_scratch", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
