"""Shared storage for cut lineage and staged writes."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``. A local session (tests) that
    names none gets a temporary one; a cluster session must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="dunlin-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lost executors cost no
    recomputation, a frame used several times is computed once, and later steps read only
    the columns they need. The folder's retention policy removes old tables."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
