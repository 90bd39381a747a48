"""Tables ready to be charted or reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w
from ledgerloom.functions.numeric import ratio
from ledgerloom.functions.quantiles import add_quantiles
from ledgerloom.params import DATE, SCENARIOS, SERIES


def forecast_feed(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """History (series_id, date, value) and forecast with its bounds in one table, nulls left out."""
    past = history.filter(F.col("value").isNotNull()).select(SERIES, DATE, "value", F.lit("history").alias("kind"))
    bounds = [c for c in ("lower_bound", "upper_bound") if c in forecast.columns]
    ahead = forecast.filter(F.col("forecast").isNotNull()).select(
        SERIES, DATE, F.col("forecast").alias("value"), F.lit("forecast").alias("kind"), *bounds
    )
    return past.unionByName(ahead, allowMissingColumns=True)


def scenario_feed(plans: DataFrame, metric: str = "free_cash_flow", scenarios=SCENARIOS) -> DataFrame:
    """One plan column, one column per scenario; a missing value counts as 0. The names are known beforehand."""
    names = [s.name for s in scenarios]
    wide = plans.groupBy(SERIES, DATE).pivot("scenario", names).agg(F.sum(F.coalesce(F.col(metric), F.lit(0.0))))
    return wide.fillna(0.0, names)


def risk_histogram(sims: DataFrame, column: str = "total_fcf", bins: int = 50) -> DataFrame:
    """Equal-width bins from least to greatest value, with counts and densities; every series has all of them.

    The ends come from an aggregate that is joined back: the simulations are read twice, so cut them first.
    """
    known = sims.filter(F.col(column).isNotNull())
    ends = known.groupBy(SERIES).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"), F.count(column).alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.floor(F.try_divide(F.col(column) - F.col("_lo"), width)).cast("int")
    # The greatest value belongs to the last bin; values that do not vary all go to the first.
    place = F.coalesce(F.least(at, F.lit(bins - 1)), F.lit(0))
    counted = known.join(ends, SERIES).groupBy(SERIES, place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counted, [SERIES, "bin"], "left").select(
        SERIES, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
        ratio(F.coalesce("count", F.lit(0)).cast("double"), F.col("_n") * width).alias("density"),
    )


def box_stats(df: DataFrame, column: str, keys=(SERIES,)) -> DataFrame:
    """Median, quartiles, and the whiskers at the furthest values within 1.5 times their distance.

    Reads its input more than once: cut it first where it is costly.
    """
    marked = add_quantiles(df.filter(F.col(column).isNotNull()), keys, {column: "_q"}, (0.25, 0.5, 0.75))
    reach = 1.5 * (F.col("_q")[2] - F.col("_q")[0])
    low = F.when(F.col(column) >= F.col("_q")[0] - reach, F.col(column))
    high = F.when(F.col(column) <= F.col("_q")[2] + reach, F.col(column))
    outside = (F.col(column) < F.col("_q")[0] - reach) | (F.col(column) > F.col("_q")[2] + reach)
    out = marked.groupBy(*w.keys(keys)).agg(
        F.first("_q").alias("_q"), F.min(low).alias("whisker_low"), F.max(high).alias("whisker_high"),
        F.count_if(outside).alias("outliers"),
    )
    return out.select(
        *w.keys(keys), "whisker_low",
        *[F.col("_q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))], "whisker_high", "outliers",
    )


def dashboard_feed(plan: DataFrame, keys=(SERIES,)) -> DataFrame:
    """What a dashboard draws from a plan: results, margin, the sign of cash flow, and capital bound."""
    filled = plan.fillna(0.0, ["sales", "gross_profit", "ebit", "free_cash_flow", "working_capital"])
    divisor = F.when(F.col("sales") == 0, F.lit(1.0)).otherwise(F.col("sales"))
    return filled.select(
        *w.keys(keys), DATE, "sales", "gross_profit", "ebit",
        (F.col("ebit") / divisor * 100).alias("ebit_margin_pct"),
        "free_cash_flow",
        F.when(F.col("free_cash_flow") >= 0, "positive").otherwise("negative").alias("fcf_sign"),
        "working_capital",
    )


def executive_kpis(metrics: DataFrame, risk: DataFrame, insights: DataFrame) -> DataFrame:
    """One row per series from the plan metrics, the risk summary and the scenario insights."""
    return (
        metrics.select(
            SERIES, "total_sales", "total_free_cash_flow", "gross_margin_percent", "ebit_margin_percent", "minimum_fcf"
        )
        .join(risk, SERIES, "left")
        .join(
            insights.select(
                SERIES, "best_case_scenario", "worst_case_scenario", "fcf_range",
                F.col("risk_level").alias("scenario_risk_level"),
            ),
            SERIES, "left",
        )
    )
