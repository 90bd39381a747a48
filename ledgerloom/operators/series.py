"""Analysis of one value per series and date, and the straight-line forecast every model falls back on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import unit_root
from ledgerloom.functions import windows as w
from ledgerloom.functions.numeric import ratio
from ledgerloom.params import DATE, SERIES, Forecasting


def series_stats(df: DataFrame) -> DataFrame:
    """Size, range, completeness, spread, and whether the last year lies above the first."""
    placed = df.withColumns(
        {
            "_from_start": F.row_number().over(w.ordered()),
            "_from_end": F.row_number().over(w.latest_first()),
        }
    )
    out = placed.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        (F.count("value") / F.count(F.lit(1)) * 100).alias("completeness"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.avg(F.when(F.col("_from_end") <= 12, F.col("value"))).alias("_late"),
        F.avg(F.when(F.col("_from_start") <= 12, F.col("value"))).alias("_early"),
    )
    rising = F.when(F.col("_late") > F.col("_early"), "increasing").otherwise("decreasing")
    return out.withColumns({"cv": ratio(F.col("std"), F.col("mean")), "trend_direction": rising}).drop("_late", "_early")


_TEST = ("n_obs long, lags long, df_statistic double, p_value double, critical_1pct double, critical_5pct double, critical_10pct double, is_stationary boolean")


def stationarity(df: DataFrame) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, of each series' known values in the order of their dates.

    The number of lagged changes is chosen by AIC. A series counts as stationary where the p-value lies below 5 %. With too few values, or where the
    changes are explained without error, there is no test, and its figures are null.
    """
    point = F.when(F.col("value").isNotNull() & ~F.isnan("value"), F.struct(DATE, "value"))
    packed = df.groupBy(SERIES).agg(F.transform(F.array_sort(F.collect_list(point)), lambda p: p["value"]).alias("y"))
    key = packed.schema[SERIES].dataType.simpleString()

    def run(stream):
        for batch in stream:
            rows: list = [None] * batch.num_rows
            values = [np.array(y, float) for y in batch["y"].to_pylist()]
            sizes = np.array([len(v) for v in values])
            for n in np.unique(sizes):
                some = np.flatnonzero(sizes == n)
                for i, months, lags, statistic in zip(some, *map(np.ndarray.tolist, unit_root.dickey_fuller(np.stack([values[i] for i in some])))):
                    rows[i] = _tested(months, lags, statistic)
            yield pa.RecordBatch.from_arrays([batch[SERIES], *map(pa.array, zip(*rows), _ARROW)], names=[SERIES, *_NAMES])

    return packed.mapInArrow(run, f"{SERIES} {key}, {_TEST}")


_NAMES = [c.split()[0] for c in _TEST.split(", ")]
_ARROW = [pa.int64(), pa.int64(), *[pa.float64()] * 5, pa.bool_()]


def _tested(months: int, lags: int, statistic: float) -> tuple:
    if np.isnan(statistic):
        return (months, *[None] * 7)
    p = unit_root.p_value(statistic)
    return (months, lags, statistic, p, *[unit_root.critical(level, months) for level in unit_root.CRITICAL], p < 0.05)


def decompose_additive(df: DataFrame, period: int = 12) -> DataFrame:
    """Trend by a centred moving average over one period, seasonal means around it, and the rest.

    Known values only. In series shorter than two periods the parts are null.
    """
    half = period // 2
    known = df.filter(F.col("value").isNotNull()).withColumns(
        {"_pos": w.position(), "_n": F.count(F.lit(1)).over(w.whole())}
    )
    full = (F.count(F.lit(1)).over(w.near(half, half)) == 2 * half + 1) & (F.col("_n") >= 2 * period)
    ends = 0.5 * (F.lag("value", half).over(w.ordered()) + F.lead("value", half).over(w.ordered()))
    inner = F.sum("value").over(w.near(half - 1, half - 1))
    out = known.withColumn("trend", F.when(full, (ends + inner) / period)).withColumn(
        "_slot", F.col("_pos") % period
    )
    out = out.withColumn("_mean", F.avg(F.col("value") - F.col("trend")).over(w.whole((SERIES, "_slot"))))
    # Every slot counts once in the centre, however often it occurs.
    first_of_slot = F.when(F.col("_pos") < period, F.col("_mean"))
    out = out.withColumn("seasonal", F.col("_mean") - F.avg(first_of_slot).over(w.whole()))
    return out.withColumn("residual", F.col("value") - F.col("trend") - F.col("seasonal")).select(
        SERIES, DATE, "value", "trend", "seasonal", "residual"
    )


def decomposition_strength(parts: DataFrame) -> DataFrame:
    """Spread of the seasonal part and of the trend against that of the series."""
    spread = F.stddev_pop("value")
    out = parts.groupBy(SERIES).agg(
        ratio(F.stddev_pop("seasonal"), spread).alias("seasonal_strength"),
        ratio(F.stddev_pop("trend"), spread).alias("trend_strength"),
    )
    return out.withColumns(
        {"has_seasonality": F.col("seasonal_strength") > 0.1, "has_trend": F.col("trend_strength") > 0.1}
    )


def _centred_products(df: DataFrame, max_lag: int) -> DataFrame:
    """Per series: length before and after dropping nulls, and sums of products of the centred values by lag.

    Lagged columns of one window, not pairs of rows: `max_lag` sums per series leave the aggregate.
    """
    sized = df.withColumn("_rows", F.count(F.lit(1)).over(w.whole())).filter(F.col("value").isNotNull())
    centred = sized.withColumn("_c", F.col("value") - F.avg("value").over(w.whole()))
    shifted = centred.withColumns({f"_c{k}": F.lag("_c", k).over(w.ordered()) for k in range(1, max_lag + 1)})
    products = [F.sum(F.col("_c") * F.col("_c"))]
    products += [F.coalesce(F.sum(F.col("_c") * F.col(f"_c{k}")), F.lit(0.0)) for k in range(1, max_lag + 1)]
    return shifted.groupBy(SERIES).agg(
        F.max("_rows").alias("_rows"), F.count(F.lit(1)).alias("_n"), F.array(*products).alias("_s")
    )


def autocorrelation(df: DataFrame, max_lag: int = 40) -> DataFrame:
    """Autocorrelation to lag min(max_lag, n/4); lags 1-12 beyond 0.2 either way are marked significant."""
    sums = _centred_products(df, max_lag)
    out = sums.select(SERIES, "_rows", "_n", F.col("_s")[0].alias("_s0"), F.posexplode("_s").alias("lag", "_sk"))
    out = out.filter((F.col("lag") <= F.floor(F.col("_rows") / 4)) & (F.col("lag") < F.col("_n")))
    acf = ratio(F.col("_sk"), F.col("_s0"))
    return out.select(
        SERIES, "lag", acf.alias("acf"),
        (F.col("lag").between(1, 12) & (F.abs(acf) > 0.2)).alias("is_significant"),
    )


def partial_autocorrelation(df: DataFrame, max_lag: int = 20) -> DataFrame:
    """Partial autocorrelation to lag min(max_lag, n/8), by the Durbin-Levinson recursion.

    Autocovariances are divided by n - k (the sample-size adjusted Yule-Walker form). The recursion runs
    over an array of at most `max_lag + 1` numbers per series.
    """
    sums = _centred_products(df, max_lag)
    top = F.least(F.lit(max_lag), F.floor(F.col("_rows") / 8).cast("int"), (F.col("_n") - 1).cast("int"))
    adjusted = F.transform("_s", lambda s, k: ratio(s, F.col("_n") - k))
    rho = sums.select(SERIES, top.alias("_top"), F.transform(adjusted, lambda v: ratio(v, adjusted[0])).alias("_r"))

    def step(acc, k):
        phi = acc["phi"]
        # r[k-1], ..., r[1] against phi[1], ..., phi[k-1]
        past = F.slice(F.col("_r"), 2, k - 1)
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
        last = ratio(F.get(F.col("_r"), k) - dot(phi, F.reverse(past)), 1.0 - dot(phi, past))
        updated = F.zip_with(phi, F.reverse(phi), lambda a, b: a - last * b)
        return F.struct(
            F.concat(updated, F.array(last)).alias("phi"), F.concat(acc["pacf"], F.array(last)).alias("pacf")
        )

    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.array(F.lit(1.0)).alias("pacf"))
    lags = F.when(F.col("_top") >= 1, F.sequence(F.lit(1), F.col("_top"))).otherwise(F.array().cast("array<int>"))
    values = F.aggregate(lags, start, step, lambda acc: acc["pacf"])
    return rho.select(SERIES, F.posexplode_outer(values).alias("lag", "pacf"))


def next_month_start(date, months):
    """The first month start not before `date` plus one month, then `months` - 1 months further."""
    follow = F.add_months(date, 1)
    start = F.when(F.dayofmonth(follow) == 1, follow).otherwise(F.add_months(F.trunc(follow, "MM"), 1))
    return F.add_months(start, months - 1)


def trend_forecasts(
    df: DataFrame,
    columns: dict[str, str],
    horizon: int = Forecasting().horizon,
    recent: int = 12,
    default: float = 3_000_000.0,
) -> DataFrame:
    """Several columns of a ledger, each extended along its own line (see `trend_forecast`), in one pass.

    `columns` maps the names of the results to the columns they continue.
    """
    back = w.latest_first().rowsBetween(w.Window.unboundedPreceding, 0)
    sized = df.withColumns({f"_k_{name}": F.count(c).over(back) for name, c in columns.items()})
    recent_x = {
        f"_x_{name}": F.when(F.col(c).isNotNull() & (F.col(f"_k_{name}") <= recent), -F.col(f"_k_{name}").cast("double"))
        for name, c in columns.items()
    }
    facts = [F.count(F.lit(1)).alias("_rows"), F.max(DATE).alias("_end")]
    for name, c in columns.items():
        x = f"_x_{name}"
        facts += [
            F.count(x).alias(f"_n_{name}"),
            F.regr_slope(c, x).alias(f"_slope_{name}"),
            F.regr_intercept(c, x).alias(f"_icept_{name}"),
            F.max_by(c, x).alias(f"_last_{name}"),
        ]
    fit = sized.withColumns(recent_x).groupBy(SERIES).agg(*facts)
    spread = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    # Positions count back from -1 at the last known value, so step k stands at k - 1.
    k = F.col("step").cast("double") - 1

    def ahead(name):
        last = F.col(f"_last_{name}")
        line = F.greatest(F.col(f"_icept_{name}") + F.col(f"_slope_{name}") * k, 0.5 * last)
        start = F.when(F.col("_rows") < 2, F.lit(default)).otherwise(F.coalesce(last, F.lit(default)))
        usable = (F.col("_rows") >= 2) & (F.col(f"_n_{name}") >= 2)
        return F.when(usable, line).otherwise(start * F.pow(F.lit(1.02), k)).alias(name)

    date = next_month_start(F.col("_end"), F.col("step")).alias(DATE)
    return spread.select(SERIES, "step", date, *[ahead(name) for name in columns])


def trend_forecast(df: DataFrame, horizon: int = Forecasting().horizon, **options) -> DataFrame:
    """Extend a straight line through the last known values, never below half the last one.

    One known value among several rows grows by 2 % a month; without a usable history the default does.
    """
    return trend_forecasts(df, {"forecast": "value"}, horizon, **options)
