"""Writers. Files are written by the executors; nothing passes through the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.params import SERIES


def round_numbers(df: DataFrame, digits: int = 2) -> DataFrame:
    """Every floating column rounded to `digits`."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes
        ]
    )


def write_plan(plan: DataFrame, path: str, fmt: str = "parquet", digits: int = 2, mode: str = "overwrite", scenario: str = "scenario") -> None:
    """A plan rounded to the report precision, in one folder per scenario where it has scenarios.

    Overwriting replaces only the scenarios that the plan has; the others, and whoever reads them meanwhile, are left alone. New files
    stand aside until all are written. Beside the plan, in `<path>.manifest`, a row per scenario says how many rows and which sums its files hold: see
    `plan_problems`.
    """
    writer = round_numbers(plan, digits).write.mode(mode).format(fmt).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    if scenario in plan.columns:
        writer = writer.partitionBy(scenario)
    writer.save(path)
    if scenario in plan.columns:
        written = read_plan(plan.sparkSession, path, plan.schema, fmt)
        touched = written.join(plan.select(scenario).distinct(), scenario, "left_semi") if mode == "overwrite" else written
        _manifest(touched, scenario).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scenario).parquet(f"{path}.manifest")


def read_plan(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A plan that `write_plan` wrote; `schema` is that of the plan."""
    reader = spark.read.schema(schema).format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)


def _manifest(plan: DataFrame, scenario: str) -> DataFrame:
    """Rows and the sum of each number per scenario. Sums are of whole hundredths, so that their order does not matter."""
    numbers = [c for c, t in plan.dtypes if t in ("double", "float", "int", "bigint") and c != scenario]
    exact = [F.sum(F.round(F.col(c) * 100).cast("decimal(38,0)")).alias(c) for c in numbers]
    return plan.groupBy(scenario).agg(F.count(F.lit(1)).alias("rows"), *exact)


def plan_problems(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", scenario: str = "scenario") -> DataFrame:
    """The scenarios whose files do not hold what the manifest says, with both numbers of rows; none where all is well."""
    told = spark.read.parquet(f"{path}.manifest")
    found = _manifest(read_plan(spark, path, schema, fmt), scenario)
    columns = [c for c in found.columns if c != scenario]
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in columns]
    both = told.alias("t").join(found.alias("f"), F.col(f"t.{scenario}") == F.col(f"f.{scenario}"), "full_outer")
    return both.where(~reduce(lambda a, b: a & b, same)).select(
        F.coalesce(F.col(f"t.{scenario}").cast("string"), F.col(f"f.{scenario}").cast("string")).alias(scenario),
        F.col("t.rows").alias("rows_told"), F.col("f.rows").alias("rows_found"))


def nest_report(sections: dict[str, DataFrame]) -> DataFrame:
    """One row per series holding each section as a struct; a section has one row per series."""
    nested = [
        df.select(SERIES, F.struct(*[c for c in df.columns if c != SERIES]).alias(name))
        for name, df in sections.items()
    ]
    return reduce(lambda a, b: a.join(b, SERIES, "full_outer"), nested)


def write_report(sections: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """The report sections as JSON lines, one document per series."""
    nest_report(sections).write.mode(mode).json(path)
