"""From transactions or loose rows to one row per series and date, and views of single columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.params import DATE, FX, OPEX, SALES, SERIES, LedgerError


def monthly_ledger(transactions: DataFrame, keys=(SERIES,)) -> DataFrame:
    """Monthly totals of sales and opex and the mean FX rate, per series.

    Sums are combined before the shuffle, so a series holding most of the rows sends one row per task
    and month.
    """
    return transactions.groupBy(*keys, F.trunc(DATE, "MM").alias(DATE)).agg(
        F.sum(SALES).alias(SALES),
        F.sum(OPEX).alias(OPEX),
        F.avg(FX).alias(FX),
    )


def _first(df: DataFrame, tie_break: str | None):
    """The row of a group that `dedup_first` keeps, as a struct."""
    rest = [c for c in df.columns if c not in (SERIES, DATE)]
    row = F.struct(*rest)
    nulls = sum((F.col(c).isNull().cast("int") for c in rest), F.lit(0))
    order = F.struct(F.col(tie_break).isNull(), tie_break, nulls, row) if tie_break else F.struct(nulls, row)
    return F.min_by(row, order).alias("row")


def dedup_first(df: DataFrame, tie_break: str | None = None) -> DataFrame:
    """One row per series and date: the one with the least `tie_break`, whole.

    A row whose tie-break is null comes after all others. Among rows that still tie, and without a tie-break, the one with
    fewest nulls is kept, then the one with the least values. A grouped minimum rather than a row number: it is combined before the shuffle, so many copies of
    one date do not meet in one task.
    """
    return df.groupBy(SERIES, DATE).agg(_first(df, tie_break)).select(SERIES, DATE, "row.*")


def first_counted(df: DataFrame, counted: dict[str, Column], tie_break: str | None = None) -> DataFrame:
    """`dedup_first`, with the number of rows of each series and date as `raw_rows` and, by name, how many of them meet each condition.

    The counts ride on the aggregation that drops repeated rows, so they cost no pass of their own, and a task that runs twice counts once. Rows without a date
    are a group of their series.
    """
    counts = {"raw_rows": F.count(F.lit(1)), **{name: F.count_if(c) for name, c in counted.items()}}
    out = df.groupBy(SERIES, DATE).agg(_first(df, tie_break), *[c.alias(name) for name, c in counts.items()])
    return out.select(SERIES, DATE, "row.*", *counts)


def extract_series(df: DataFrame, column: str) -> DataFrame:
    """One column as a dated series (series_id, date, value)."""
    if column not in df.columns:
        raise LedgerError(f"column {column!r} not found; available: {df.columns}")
    return df.select(SERIES, DATE, F.col(column).cast("double").alias("value"))
