"""Scenarios as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.params import SCENARIOS, select_scenarios


def scenario_array(scenarios) -> Column:
    """The scenarios as an array literal, to be exploded next to each row instead of joined."""
    return F.array(
        *[
            F.struct(
                F.lit(s.name).alias("scenario"),
                F.lit(float(s.sales_change)).alias("sales_change"),
                F.lit(float(s.fx_change)).alias("fx_change"),
                F.lit(float(s.opex_change)).alias("opex_change"),
                F.lit(s.description).alias("scenario_description"),
            )
            for s in scenarios
        ]
    )


def scenario_table(spark: SparkSession, names=None, available=SCENARIOS) -> DataFrame:
    """The named scenarios as a table; an unknown name is an error."""
    chosen = select_scenarios(names, available)
    return spark.range(1).select(F.inline(scenario_array(chosen)))
