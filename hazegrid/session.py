"""Where a job may keep intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    named = spark.conf.get(_SETTING, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a shared folder before running this job")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="hazegrid-")
    return _local[context.applicationId]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_CODE_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once and go on from the files.

    Cuts the lineage between window-heavy passes, so that a pass which reads
    its input twice does not compute it twice, and a lost executor costs one
    pass and not the whole job.

    What is staged is wide. Beyond 8000 bytes the JVM only interprets a
    method, so for the write Spark is told to split generated code above that.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CODE_LIMIT)
    spark.conf.set(_CODE_LIMIT, "8000")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CODE_LIMIT, before)
    return spark.read.schema(df.schema).parquet(path)
