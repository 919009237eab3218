"""Intermediate tables of the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.session import scratch

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: later passes don't repeat it, and a lost executor costs no earlier step."""
    path = scratch(df.sparkSession, name)
    with no_leftovers(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def unstaged(*tables: DataFrame | None) -> None:
    """The folders of those among `tables` that `staged` has returned go: nothing may read them any more, results that aren't written yet included."""
    for table in tables:
        path = None if table is None else _paths.pop(table, None)
        if path:
            removed(table.sparkSession, path)


def removed(spark: SparkSession, path: str) -> None:
    """A folder that `scratch` has named goes, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def no_leftovers(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in here go when it ends. Otherwise they stay on the executors' disks until the driver's JVM happens to collect the plan."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def remainder(column: str, n: int) -> Column:
    """crc32 of a column as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def spread(*columns: str) -> Column:
    """A value from 0 to 1 that a row's columns decide, even over rows."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / float(1 << 53)
