"""Intermediate tables, and columns that are computed once."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITTEN: list[str] = []
_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a session on one machine does without it: its
    executors all see a folder made here. On a cluster that would lose data, and is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="gnomon-"))
    return _LOCAL[0]


def written(df: DataFrame) -> DataFrame:
    """df written once as Parquet in the shared folder, and read from there: the plan starts anew, and a lost
    executor costs a reread. Tables of a session are removed when the driver ends."""
    spark, path = df.sparkSession, place(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def place(spark: SparkSession) -> str:
    """A new path in the shared folder, which goes when the driver ends."""
    path = f"{shared_folder(spark)}/gnomon-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_remove, spark)
    _WRITTEN.append(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that it holds."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _remove(spark: SparkSession) -> None:
    """Remove the session's own tables, if its JVM still runs."""
    with contextlib.suppress(Exception):
        for path in [*_WRITTEN, *_LOCAL]:
            drop(spark, path)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that later ones use many times. The optimizer copies an expression into each of its uses,
    and a long one into copies of copies, but it does not carry one through a Generate."""
    return df.select("*", F.inline(F.array(F.struct(*(x.alias(name) for name, x in columns.items())))))


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """left with the other columns of right; a null key meets a null one. Without keys right is one row."""
    if not keys:
        return left.crossJoin(F.broadcast(right.limit(1)))
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys]
    return left.join(other, on, how).drop(*(f"_right_{k}" for k in keys))
