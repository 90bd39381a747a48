"""Tables in the shared folder, column names that do not clash, and rows annotated in place."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word, and what stands between words. Both are sets of single bytes in UTF-8.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names. Where it is unset a temporary one serves, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _folder_of_this_process()
    return folder.rstrip("/")


@cache
def _folder_of_this_process() -> str:
    return tempfile.mkdtemp(prefix="ledgerloom-")


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: computed once, lineage cut, safe from lost executors.

    The folder is left to the cluster's own retention, as with checkpoints: a lazy result may still read it.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """`names`, lengthened by underscores until none is a column of `df`."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def annotate(df: DataFrame, inputs: list[str], result: T.StructType, name: str, prepare: Callable) -> DataFrame:
    """`df` with a struct column `name` of type `result`, worked out beside the rows, which do not move.

    `prepare()` runs once in each task; what it returns gets the Arrow arrays of `inputs`, batch after batch, and returns
    an Arrow struct array of the same length.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, result)])

    def run(stream):
        work = prepare()
        for batch in stream:
            made = work(*[batch.column(i) for i in inputs])
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blank_null(c):
    return F.coalesce(c, F.lit(""))
