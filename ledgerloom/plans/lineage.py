"""Cutting lineage so that costly results are computed once and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder the session names in `spark.checkpoint.dir`, and read again.

    Where none is named the frame is persisted in memory and on disk: computed once too, and what a lost executor held is
    computed again.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{folder.rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that `spark.checkpoint.dir` names. Where it is unset, on a local master, in a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
