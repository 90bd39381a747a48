"""Descriptive profiles. Input: one row per series and date, with the growth columns of `features.add_growth`.

Each operator is one aggregate by series, after at most one pass of windows over the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w
from ledgerloom.functions.numeric import correlation_t, pearson, ratio, student_t_tail
from ledgerloom.params import DATE, FX, OPEX, SALES, SERIES

SALES_GROWTH, FX_GROWTH = "sales_growth_mom", "fx_change_mom"


def growth_stats(df: DataFrame) -> DataFrame:
    """Mean and spread of the monthly growth of sales and FX, and how the spreads compare."""
    stats = df.groupBy(SERIES).agg(
        F.avg(SALES_GROWTH).alias("sales_monthly_mean"),
        F.stddev_samp(SALES_GROWTH).alias("sales_monthly_std"),
        F.avg(FX_GROWTH).alias("fx_monthly_mean"),
        F.stddev_samp(FX_GROWTH).alias("fx_monthly_std"),
    )
    return stats.withColumn("volatility_ratio", ratio(F.col("sales_monthly_std"), F.col("fx_monthly_std")))


def linear_trend(df: DataFrame) -> DataFrame:
    """Least-squares line of sales and of FX over row positions: slope, r squared, t and its p-value."""
    placed = df.withColumn("_pos", w.position().cast("double"))
    sides = {"sales": SALES, "fx": FX}
    fits = []
    for name, c in sides.items():
        fits += [
            F.regr_slope(F.col(c), F.col("_pos")).alias(f"{name}_trend_slope"),
            F.regr_r2(F.col(c), F.col("_pos")).alias(f"{name}_trend_r_squared"),
            F.regr_count(F.col(c), F.col("_pos")).alias(f"_{name}_n"),
        ]
    out = placed.groupBy(SERIES).agg(*fits)
    for name in sides:
        r2, n = F.col(f"{name}_trend_r_squared"), F.col(f"_{name}_n")
        out = out.withColumn(f"{name}_trend_t", F.signum(f"{name}_trend_slope") * correlation_t(r2, n))
        tail = student_t_tail(F.abs(f"{name}_trend_t"), n - 2)
        perfect = (r2 >= 1.0) & (n > 2)
        out = out.withColumn(f"{name}_trend_p_value", F.when(perfect, F.lit(0.0)).otherwise(tail))
    return out.drop("_sales_n", "_fx_n")


def month_profile(df: DataFrame) -> DataFrame:
    """Mean and spread of sales by calendar month, with the best and the weakest month of the series."""
    by_month = df.groupBy(SERIES, F.month(DATE).alias("month")).agg(
        F.avg(SALES).alias("avg_sales"), F.stddev_samp(SALES).alias("std_sales")
    )
    span = w.whole()
    # A tie goes to the earliest month.
    high = F.max_by("month", F.struct(F.col("avg_sales"), -F.col("month"))).over(span)
    low = F.min_by("month", F.struct(F.col("avg_sales"), F.col("month"))).over(span)
    return by_month.withColumns({"peak_month": high, "trough_month": low})


def quarter_profile(df: DataFrame) -> DataFrame:
    """Mean sales by quarter, and how far the fourth lies above the mean of the quarter means."""
    by_quarter = df.groupBy(SERIES, F.quarter(DATE).alias("quarter")).agg(F.avg(SALES).alias("avg_sales"))
    span = w.whole()
    mean = F.avg("avg_sales").over(span)
    fourth = F.max(F.when(F.col("quarter") == 4, F.col("avg_sales"))).over(span)
    return by_quarter.withColumn("q4_premium", F.coalesce(ratio(fourth - mean, mean), F.lit(0.0)))


def year_end_effect(df: DataFrame) -> DataFrame:
    """How far mean December sales lie above the mean of the other months."""
    december = F.month(DATE) == 12
    means = df.groupBy(SERIES).agg(
        F.avg(F.when(december, F.col(SALES))).alias("december_mean"),
        F.avg(F.when(~december, F.col(SALES))).alias("other_mean"),
    )
    effect = ratio(F.col("december_mean") - F.col("other_mean"), F.col("other_mean"))
    return means.withColumn("year_end_effect", effect)


def detrended_strength(df: DataFrame) -> DataFrame:
    """Spread left after removing a straight line, as a share of the spread: sqrt(1 - r squared)."""
    placed = df.withColumn("_pos", w.position().cast("double"))
    r2 = F.regr_r2(F.col(SALES), F.col("_pos"))
    return placed.groupBy(SERIES).agg(F.sqrt(F.greatest(F.lit(0.0), 1.0 - r2)).alias("seasonal_strength"))


def annual_totals(df: DataFrame) -> DataFrame:
    """Sales, opex and mean FX by year, with the growth of sales against the year before."""
    yearly = df.groupBy(SERIES, F.year(DATE).alias("year")).agg(
        F.sum(SALES).alias("sales"), F.sum(OPEX).alias("opex"), F.avg(FX).alias("fx")
    )
    return yearly.withColumn("sales_growth", w.change(F.col("sales"), order="year"))


def annual_growth(df: DataFrame) -> DataFrame:
    """Mean yearly growth and compound annual growth; both 0 where there is one year only."""
    out = annual_totals(df).groupBy(SERIES).agg(
        F.avg("sales_growth").alias("average_annual_growth"),
        F.min_by("sales", "year").alias("_first"),
        F.max_by("sales", "year").alias("_last"),
        F.count(F.lit(1)).alias("years_analyzed"),
    )
    years = F.col("years_analyzed") - 1
    growth = F.pow(ratio(F.col("_last"), F.col("_first")), ratio(F.lit(1.0), years)) - 1
    one_year = years == 0
    return out.select(
        SERIES,
        F.when(one_year, 0.0).otherwise(F.col("average_annual_growth")).alias("average_annual_growth"),
        F.when(one_year, 0.0).otherwise(F.when(~F.isnan(growth), growth)).alias("cagr"),
        "years_analyzed",
    )


def growth_consistency(df: DataFrame) -> DataFrame:
    """Share of months that grew, and the direction of the mean annual growth.

    Both need the same rows once: months are counted inside the yearly totals.
    """
    yearly = df.groupBy(SERIES, F.year(DATE).alias("year")).agg(
        F.sum(SALES).alias("sales"),
        F.count_if(F.col(SALES_GROWTH) > 0).alias("_up"),
        F.count(SALES_GROWTH).alias("_all"),
    )
    out = (
        yearly.withColumn("_growth", w.change(F.col("sales"), order="year"))
        .groupBy(SERIES)
        .agg(
            F.coalesce(ratio(F.sum("_up").cast("double"), F.sum("_all")), F.lit(0.0)).alias("positive_growth_ratio"),
            F.coalesce(F.avg("_growth"), F.lit(0.0)).alias("_mean"),
        )
    )
    direction = F.when(F.col("_mean") > 0.05, "Upward").when(F.col("_mean") < -0.05, "Downward").otherwise("Stable")
    return out.withColumn("trend_direction", direction).drop("_mean")


def correlation_matrix(df: DataFrame) -> DataFrame:
    """Pearson correlations of the three measures."""
    return df.groupBy(SERIES).agg(
        pearson(F.col(SALES), F.col(FX)).alias("sales_fx"),
        pearson(F.col(SALES), F.col(OPEX)).alias("sales_opex"),
        pearson(F.col(FX), F.col(OPEX)).alias("fx_opex"),
    )


def lagged_correlation(df: DataFrame, lags: int = 6) -> DataFrame:
    """Correlation of sales with earlier FX, for each lag that the series is long enough for."""
    shifted = df.withColumns({f"_fx{k}": F.lag(FX, k).over(w.ordered()) for k in range(1, lags + 1)})
    facts = [
        F.struct(
            F.lit(k).alias("lag"),
            F.coalesce(pearson(F.col(SALES), F.col(f"_fx{k}")), F.lit(0.0)).alias("correlation"),
        )
        for k in range(1, lags + 1)
    ]
    grouped = shifted.groupBy(SERIES).agg(F.count(F.lit(1)).alias("_n"), F.array(*facts).alias("_facts"))
    return grouped.select(SERIES, "_n", F.inline("_facts")).filter(F.col("_n") > F.col("lag")).drop("_n")


def add_rolling_volatility(df: DataFrame, rows: int = 3) -> DataFrame:
    """Trailing sample std of growth over `rows` months, null until all of them are known."""

    def trailing(c):
        frame = w.near(rows - 1, 0)
        return F.when(F.count(c).over(frame) == rows, F.stddev_samp(c).over(frame))

    return df.withColumns({"sales_rolling_vol": trailing(SALES_GROWTH), "fx_rolling_vol": trailing(FX_GROWTH)})


def rolling_volatility(df: DataFrame) -> DataFrame:
    """Mean and peak of the rolling volatility; needs `add_rolling_volatility`."""
    return df.groupBy(SERIES).agg(
        F.avg("sales_rolling_vol").alias("sales_mean"),
        F.max("sales_rolling_vol").alias("sales_max"),
        F.avg("fx_rolling_vol").alias("fx_mean"),
        F.max("fx_rolling_vol").alias("fx_max"),
    )


def volatility_clusters(df: DataFrame) -> DataFrame:
    """The upper quartile of the rolling volatility, and how many months lie above it."""
    marked = df.withColumn("threshold", F.percentile("sales_rolling_vol", 0.75).over(w.whole()))
    return marked.groupBy(SERIES).agg(
        F.first("threshold").alias("threshold"),
        F.count_if(F.col("sales_rolling_vol") > F.col("threshold")).alias("high_volatility_periods"),
    )


def volatility_persistence(df: DataFrame) -> DataFrame:
    """Correlation of the rolling volatility with itself one row earlier; 0 with fewer than two values."""
    lagged = df.withColumn("_prev", F.lag("sales_rolling_vol").over(w.ordered()))
    corr = pearson(F.col("sales_rolling_vol"), F.col("_prev"))
    enough = F.count("sales_rolling_vol") > 1
    return lagged.groupBy(SERIES).agg(F.when(enough, corr).otherwise(0.0).alias("volatility_persistence"))


def top_periods(df: DataFrame, k: int = 3) -> DataFrame:
    """The k best months by sales, the mean FX in them, and that against the mean FX overall."""
    rank = F.row_number().over(w.Window.partitionBy(SERIES).orderBy(F.col(SALES).desc(), DATE))
    ranked = df.withColumns({"_avg_fx": F.avg(FX).over(w.whole()), "rank": rank}).filter(F.col("rank") <= k)
    peak = F.avg(FX).over(w.whole())
    return ranked.withColumn("avg_fx_during_peaks", peak).select(
        SERIES, "rank", DATE, SALES, FX, "avg_fx_during_peaks",
        (ratio(F.col("avg_fx_during_peaks"), F.col("_avg_fx")) - 1).alias("fx_vs_average"),
    )


def top_acceleration(df: DataFrame, k: int = 3) -> DataFrame:
    """The k months whose growth rose most."""
    rank = F.row_number().over(w.Window.partitionBy(SERIES).orderBy(F.col("growth_acceleration").desc(), DATE))
    known = df.filter(F.col("growth_acceleration").isNotNull())
    return known.withColumn("rank", rank).filter(F.col("rank") <= k).select(SERIES, "rank", DATE, "growth_acceleration")


def sensitivity_labels(df: DataFrame) -> DataFrame:
    """Words for the volatility of growth and for the tie between sales and FX."""
    out = df.groupBy(SERIES).agg(
        F.stddev_samp(SALES_GROWTH).alias("_vol"), F.abs(pearson(F.col(SALES), F.col(FX))).alias("_corr")
    )
    vol, corr = F.col("_vol"), F.col("_corr")
    return out.select(
        SERIES,
        F.when(vol > 0.15, "High").when(vol > 0.08, "Moderate").otherwise("Low").alias("growth_volatility_assessment"),
        F.when(corr > 0.5, "High").when(corr > 0.3, "Moderate").otherwise("Low").alias("fx_sensitivity_level"),
    )
