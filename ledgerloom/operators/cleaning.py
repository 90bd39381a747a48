"""Filling, bounding and smoothing a ledger. Input: one row per series and date."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w
from ledgerloom.functions.numeric import clip, finite
from ledgerloom.operators.quality import trim_dates
from ledgerloom.params import DATE, FX, OPEX, SALES, SERIES, Finance, Rules
from ledgerloom.sources.rollup import dedup_first

DEFAULT_MEDIAN = 2_500_000.0


def _listed(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _with_neighbours(df: DataFrame, columns: list[str], axis: Column | None = None, by=SERIES, order=DATE) -> DataFrame:
    """Add each column's known neighbours and their places along an axis: `_v0_/_x0_` before, `_v1_/_x1_` after a row. Without an axis it is the row's position.

    All columns are read in one pass backwards and one forwards: two sorts whatever their number, the last of which serves what follows.
    """
    backwards = w.latest_first(by, order)
    df = df.withColumn("_x", -F.row_number().over(backwards).cast("double") if axis is None else axis.cast("double"))
    place = lambda c: F.when(F.col(c).isNotNull(), F.col("_x"))
    df = df.withColumns({f"_{n}1_{c}": w.next_known(v, by, order) for c in columns for n, v in (("v", F.col(c)), ("x", place(c)))})
    return df.withColumns({f"_{n}0_{c}": w.last_known(v, by, order) for c in columns for n, v in (("v", F.col(c)), ("x", place(c)))})


def _without_neighbours(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop("_x", *[f"_{n}_{c}" for c in columns for n in ("v0", "x0", "v1", "x1")])


def _on_line(c: str) -> Column:
    before, after, share = F.col(f"_v0_{c}"), F.col(f"_v1_{c}"), F.try_divide(F.col("_x") - F.col(f"_x0_{c}"), F.col(f"_x1_{c}") - F.col(f"_x0_{c}"))
    return before + (after - before) * share


def fill_forward_back(df: DataFrame, columns) -> DataFrame:
    """The last known value; before the first known one, the next."""
    backwards = df.withColumns({f"_v1_{c}": w.next_known(F.col(c)) for c in columns})
    return backwards.withColumns({c: F.coalesce(w.last_known(F.col(c)), f"_v1_{c}") for c in columns}).drop(*[f"_v1_{c}" for c in columns])


def interpolate_linear(df: DataFrame, columns, by=SERIES, order=DATE) -> DataFrame:
    """Straight lines over row positions; both ends are held flat."""
    columns = _listed(columns)
    placed = _with_neighbours(df, columns, None, by, order)
    return _without_neighbours(placed.withColumns({c: F.coalesce(F.col(c), _on_line(c), f"_v0_{c}", f"_v1_{c}") for c in columns}), columns)


def interpolate_time(df: DataFrame, columns, by=SERIES, order=DATE, leading=()) -> DataFrame:
    """Straight lines over elapsed days; trailing nulls take the last value. Leading ones stay, but in the columns `leading` they take the first value."""
    columns = _listed(columns)
    placed = _with_neighbours(df, columns, F.unix_date(order), by, order)
    ends = {c: [f"_v0_{c}", *([f"_v1_{c}"] if c in leading else [])] for c in columns}
    return _without_neighbours(placed.withColumns({c: F.coalesce(F.col(c), _on_line(c), *ends[c]) for c in columns}), columns)


def _seasonal(df: DataFrame, column: str, min_known: int) -> DataFrame:
    """Filled along each month of the year, where enough values are known."""
    raw = df.withColumns(
        {
            "_raw": F.col(column),
            "_month": F.month(DATE),
            "_known": F.count(column).over(w.whole()),
        }
    )
    by_month = interpolate_time(raw, column, by=(SERIES, "_month"))
    chosen = F.when(F.col("_known") < min_known, F.col("_raw")).otherwise(F.col(column))
    return by_month.withColumn(column, chosen).drop("_raw", "_month", "_known")


def interpolate_seasonal(df: DataFrame, column: str, min_known: int = 12) -> DataFrame:
    """Fill along each month of the year, then along time; with few known values along time only."""
    return interpolate_time(_seasonal(df, column, min_known), column)


def impute_ladder(df: DataFrame, column: str = SALES, default: float = DEFAULT_MEDIAN, neighbours=()) -> DataFrame:
    """Positions, then neighbours, then the median, then a default, whichever first gives a value.

    The columns in `neighbours` are filled by neighbours alone, in the same passes.
    """
    columns = [column, *neighbours]
    median = F.percentile(column, 0.5).over(w.whole())
    placed = _with_neighbours(df.withColumn("_median", F.when(median > 0, median)), columns)
    line = F.coalesce(F.col(column), _on_line(column), f"_v0_{column}", f"_v1_{column}", "_median", F.lit(default))
    filled = placed.withColumns({column: line, **{c: F.coalesce(F.col(c), f"_v0_{c}", f"_v1_{c}") for c in neighbours}})
    return _without_neighbours(filled, columns).drop("_median")


def prepare_ledger(df: DataFrame) -> DataFrame:
    """What loading does to a valid ledger: fill sales by the ladder, opex and FX by neighbours."""
    return impute_ladder(df, SALES, neighbours=(OPEX, FX))


def clip_fx(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return df.withColumn(FX, clip(F.col(FX), rules.min_fx, rules.max_fx))


def winsorize(df: DataFrame, column: str = SALES, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Bound a column by two of its own quantiles."""
    bounds = F.percentile(column, F.array(F.lit(lower), F.lit(upper))).over(w.whole())
    bounded = df.withColumn("_bounds", bounds)
    return bounded.withColumn(column, clip(F.col(column), F.col("_bounds")[0], F.col("_bounds")[1])).drop("_bounds")


def winsorize_ledger(df: DataFrame) -> DataFrame:
    """Bound sales by its 1st and 99th percentile, then make every measure positive."""
    df = winsorize(df, SALES)
    return df.withColumns({c: F.abs(c) for c in (SALES, OPEX, FX)})


def smooth_median_mean(df: DataFrame, column: str, median_rows: int = 7, mean_rows: int = 3) -> DataFrame:
    """A centred rolling median, then a centred rolling mean; short at the edges, nulls skipped."""
    half, third = median_rows // 2, mean_rows // 2
    df = df.withColumn(column, F.percentile(column, 0.5).over(w.near(half, half)))
    return df.withColumn(column, F.avg(column).over(w.near(third, third)))


def recompute_opex(df: DataFrame) -> DataFrame:
    """Opex as a smoothed, seasonal, bounded share of sales."""
    usable = (F.col(SALES) > 0) & (F.col(OPEX) >= 0)
    share = F.when(usable, clip(F.try_divide(F.col(OPEX), F.col(SALES)), 0.05, 1.0))
    df = smooth_median_mean(df.withColumn("_share", share), "_share")
    base = clip(F.coalesce(F.percentile("_share", 0.5).over(w.whole()), F.lit(0.30)), 0.25, 0.35)
    df = df.withColumn("_base", base)
    month = F.month(DATE)
    season = (1.0 + 0.025 * F.sin(2 * math.pi * (month - 1) / 12)) * F.when(month >= 10, 1.015).otherwise(1.0)
    bounded = clip(clip(F.coalesce("_share", "_base"), 0.20, 0.40) * season, 0.20, 0.40)
    return df.withColumn(OPEX, bounded * F.col(SALES)).drop("_share", "_base")


def reindex_calendar(df: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Complete each series to every month start it spans; missing months become rows of nulls.

    A row belongs to the month it is dated in. Several in one month are combined as in a monthly ledger: sums of sales and opex,
    the mean of FX, of other columns the greatest. Each row is then spread over the months up to the next one, which
    needs neither a spine table nor a join. Undated rows fall away. `first` and `last` stretch the span.
    """
    values = [c for c in df.columns if c not in (SERIES, DATE)]
    combine = {SALES: F.sum, OPEX: F.sum, FX: F.avg}
    on_spine = df.filter(F.col(DATE).isNotNull()).groupBy(SERIES, F.trunc(DATE, "MM").alias(DATE)).agg(
        F.count(F.lit(1)).alias("_rows"), *[combine.get(c, F.max)(c).alias(c) for c in values]).drop("_rows")
    earlier, later = F.lag(DATE).over(w.ordered()), F.lead(DATE).over(w.ordered())
    start, stop = F.col(DATE), F.coalesce(F.add_months(later, -1), F.col(DATE))
    if first:
        start = F.when(earlier.isNull(), F.least(F.lit(first).cast("date"), F.col(DATE))).otherwise(F.col(DATE))
    if last:
        stop = F.when(later.isNull(), F.greatest(F.lit(last).cast("date"), F.col(DATE))).otherwise(stop)
    spread = on_spine.withColumns({"_start": start, "_stop": stop}).withColumn(
        "_month", F.explode(F.expr("sequence(_start, _stop, interval 1 month)"))
    )
    return spread.select(
        SERIES,
        F.col("_month").alias(DATE),
        *[F.when(F.col("_month") == F.col(DATE), F.col(c)).alias(c) for c in values],
    )


def handle_missing(df: DataFrame, rules: Rules = Rules(), min_known: int = 12) -> DataFrame:
    """Seasonal filling and smoothing of sales; elapsed-day filling and bounding of FX, whose ends take the nearest value."""
    df = interpolate_time(_seasonal(df, SALES, min_known), (SALES, FX), leading=(FX,))
    return clip_fx(smooth_median_mean(df, SALES), rules)


def repair_ledger(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The repair of a ledger that has one row per series and date."""
    df = reindex_calendar(trim_dates(df, rules.first_date, rules.last_date))
    return recompute_opex(handle_missing(winsorize_ledger(clip_fx(df, rules)), rules))


def clean_ledger(df: DataFrame, rules: Rules = Rules(), tie_break: str | None = None) -> DataFrame:
    """The whole repair of a standardized ledger, up to but without the optional features; `plans.pipelines.clean_job` starts from text and adds them."""
    df = dedup_first(df, tie_break)
    return repair_ledger(df.drop(tie_break) if tie_break else df, rules)


def sanitize_forecast(
    df: DataFrame, column: str = "sales", order: str = DATE, by=SERIES, finance: Finance = Finance()
) -> DataFrame:
    """Make a forecast usable for planning: no gaps, no infinities, and no values at or below zero.

    If any value of a series is not positive, every value of that series is raised to the floor.
    """
    gaps = df.withColumn(column, F.when(~F.isnan(column), F.col(column)))
    filled = interpolate_linear(gaps, column, by, order)
    emergency = F.lit(finance.emergency_sales)
    filled = filled.withColumn(column, F.coalesce(finite(F.col(column)), emergency))
    lowest = F.min(column).over(w.whole(by))
    floored = F.when(lowest <= 0, F.greatest(F.col(column), F.lit(finance.floor_sales)))
    return filled.withColumn("_low", floored).withColumn(column, F.coalesce("_low", column)).drop("_low")
