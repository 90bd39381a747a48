"""Accuracy, model choice, forecasts with bounds, validation and the model store.

Computed arrays are unfolded with the `_outer` generators: the plain ones make the optimizer add a filter on the
size of the array, which computes the array a second time.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w
from ledgerloom.functions.arrays import compute
from ledgerloom.functions.numeric import finite, pearson, ratio
from ledgerloom.operators.models import (
    MODELS, fit_models, pack_series, run_models, trend_line,
)
from ledgerloom.operators.series import next_month_start
from ledgerloom.params import DATE, SERIES, Forecasting
from ledgerloom.plans.lineage import cut


def accuracy_measures(actual="actual", predicted="predicted") -> list[Column]:
    """Error measures over the rows where both sides are known; the caller filters.

    A zero actual has no relative error and is left out of the two percentages.
    """
    a, p = F.col(actual), F.col(predicted)
    gap = F.abs(a - p)
    return [
        F.count(F.lit(1)).alias("n_points"),
        F.avg(gap).alias("mae"),
        F.avg(gap * gap).alias("mse"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (F.avg(ratio(gap, F.abs(a))) * 100).alias("mape"),
        (F.avg(ratio(2 * gap, F.abs(a) + F.abs(p))) * 100).alias("smape"),
        F.coalesce(F.pow(pearson(a, p), F.lit(2)), F.when(F.count(F.lit(1)) == 1, 0.0)).alias("r_squared"),
    ]


def accuracy(df: DataFrame, keys=(SERIES, "model")) -> DataFrame:
    """mae, mse, rmse, mape, smape and squared correlation per key, over rows with both values known."""
    cleaned = df.withColumns({"actual": finite(F.col("actual")), "predicted": finite(F.col("predicted"))})
    return cleaned.dropna(subset=["actual", "predicted"]).groupBy(*keys).agg(*accuracy_measures())


def fitted_values(run: DataFrame) -> DataFrame:
    """Actual and fitted value per series, model and known month, from `run_models`. A model that is not fitted has no fitted values."""
    points = F.arrays_zip(
        F.col("dates").alias("date"), F.col("y").alias("actual"), F.col("known").alias("known"), F.col("run.fitted").alias("predicted"))
    unfolded = run.select(SERIES, "model", F.inline_outer(points)).toDF(SERIES, "model", DATE, "actual", "known", "predicted")
    return unfolded.where(F.coalesce("known", F.lit(True))).drop("known")


def select_model(scores: DataFrame, by: str = "mape") -> DataFrame:
    """The model with the least error per series; a tie goes to the first name."""
    return scores.groupBy(SERIES).agg(
        F.min_by("model", F.struct(F.coalesce(F.col(by), F.lit(float("inf"))), "model")).alias("model"),
        F.min(by).alias(by),
    )


def acceptance_gate(scores: DataFrame, settings: Forecasting = Forecasting()) -> DataFrame:
    """Mark the fits that are close enough to be used."""
    good = (F.col("r_squared") >= settings.min_r2) & (F.col("mape") <= settings.max_mape)
    return scores.withColumn("accepted", F.coalesce(good, F.lit(False)))


def tournament(df: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """Fit and run every model on every series: one row each, with its in-sample accuracy as `scores`, or the reason why it has none."""
    return _scored(fit_models(pack_series(df), models, settings), settings)


def _scored(fitted: DataFrame, settings: Forecasting) -> DataFrame:
    return compute(run_models(fitted, settings.horizon, settings), {"scores": IN_SAMPLE})


# Number of points, mean squared error and mean relative error of known `y` and `run.fitted`, without leaving the row.
IN_SAMPLE = """get(transform(
    array(filter(zip_with(zip_with(y, known, (a, k) -> if(k, a, null)), run.fitted, (a, p) -> named_struct('a', a, 'p', p)),
                 q -> q.a is not null and q.p is not null and not isnan(q.p) and abs(q.p) < double('infinity'))),
    pairs -> named_struct(
        'n_points', size(pairs),
        'mse', try_divide(aggregate(pairs, 0D, (s, q) -> s + (q.a - q.p) * (q.a - q.p)), size(pairs)),
        'mape', 100D * try_divide(aggregate(pairs, 0D, (s, q) -> s + coalesce(try_divide(abs(q.a - q.p), abs(q.a)), 0D)),
                                  size(filter(pairs, q -> q.a <> 0D))))), 0)"""


def _best_forecast(df: DataFrame, models, settings: Forecasting) -> DataFrame:
    """(series, model, step, date, forecast, spread, season) of each series' best model."""
    packed = compute(pack_series(df), {"line": trend_line(settings.horizon)})
    run = _scored(fit_models(packed, models, settings), settings)
    values = F.col("run.forecast")
    valid = values.isNotNull() & ~F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # Rows without an order take no part in the choice.
    order = F.when(valid, F.struct(F.coalesce(F.col("scores.mape"), F.lit(float("inf"))), "model"))
    best = run.groupBy(SERIES).agg(
        F.min_by(F.struct("model", values.alias("forecast"), F.col("run.spread").alias("spread"), F.col("run.season").alias("season")), order).alias("b"),
        F.first("line").alias("line"),
        F.first("end").alias("end"),
    )
    unfolded = best.select(SERIES, "b.model", "b.spread", "b.season", "end", F.posexplode_outer(F.coalesce("b.forecast", "line")).alias("_k", "forecast"))
    step = F.col("_k") + 1
    return unfolded.select(
        SERIES, F.coalesce("model", F.lit("trend")).alias("model"), step.alias("step"), next_month_start(F.col("end"), step).alias(DATE),
        "forecast", F.get("spread", F.col("_k")).alias("spread"), F.get("season", F.col("_k")).alias("season"))


def forecast_horizon(df: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """The best model of each series carried forward, with the bounds of that model.

    A bound lies as many standard deviations of the forecast's error away as the confidence asks for: errors to come pass on through the smoothing weights
    or the autoregression, and a line adds what its coefficients are unsure of.

    A series for which no model can be fitted, or whose forecast holds an invalid number, gets the trend
    forecast, without bounds.
    """
    margin = NormalDist().inv_cdf(0.5 + settings.confidence / 2) * F.col("spread")
    return _best_forecast(df, models, settings).select(
        SERIES, "model", "step", DATE, "forecast", (F.col("forecast") - margin).alias("lower_bound"),
        (F.col("forecast") + margin).alias("upper_bound"), F.lit(settings.confidence).alias("confidence_level"))


def forecast_components(df: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """The best forecast of each series parted into trend and season: their sum is the forecast. The autoregression does not tell them apart and has nulls; the trend forecast
    of a series without a model is all trend."""
    best = _best_forecast(df, models, settings)
    season = F.when(F.col("model") == "trend", 0.0).otherwise(F.col("season"))
    return best.select(SERIES, "model", "step", DATE, "forecast", (F.col("forecast") - season).alias("trend"), season.alias("season"))


def holdout_validation(df: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """Fit without the last months, forecast them, and measure each model on those that are known.

    Every series has a row for every model; where nothing could be measured the figures are null and `reason` says why.
    """
    h = settings.holdout
    first = F.greatest(F.col("n") - h, F.lit(0))
    cut = pack_series(df).select(
        SERIES,
        *[F.slice(c, F.lit(1), first).alias(c) for c in ("dates", "y", "known")],
        first.alias("n"),
        F.when(F.col("n") >= h, F.zip_with(F.slice("y", -h, h), F.slice("known", -h, h), lambda v, k: F.when(k, v))).alias("held"),
    )
    fitted = fit_models(cut, models, settings)
    run = run_models(fitted, h, settings)
    pairs = run.select(
        SERIES, "model", "reason", F.inline_outer(F.arrays_zip(F.col("held").alias("actual"), F.col("run.forecast").alias("predicted")))
    ).toDF(SERIES, "model", "reason", "actual", "predicted")
    return _accuracy_of_all(pairs)


def _accuracy_of_all(points: DataFrame) -> DataFrame:
    """`accuracy`, with a row for every series and model: measures skip what is not known on both sides."""
    both = F.col("actual").isNotNull() & finite(F.col("predicted")).isNotNull()
    known = points.withColumns({c: F.when(both, finite(F.col(c))) for c in ("actual", "predicted")})
    count, *measures = accuracy_measures()
    squared = F.when(F.count("actual") > 1, F.pow(pearson(F.col("actual"), F.col("predicted")), F.lit(2))).when(F.count("actual") == 1, 0.0)
    out = known.groupBy(SERIES, "model").agg(
        F.count("actual").alias("n_points"), *measures[:-1], squared.alias("r_squared"), F.first("reason").alias("reason"))
    return out.withColumn("reason", F.when(F.col("n_points") == 0, F.coalesce("reason", F.lit("nothing to measure"))))


def rolling_backtest_points(df: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """One-step forecasts of every known month that has a full window before it, by the models that `forecast_horizon`
    chooses from, each fitted anew in every window.

    Each origin takes its own window out of the packed series, so no rows are joined; windows are dealt out over the cluster
    by series and origin. A series without a full window has one row for each model, with nulls.
    """
    size = settings.window
    packed = pack_series(df)
    places = F.sequence(F.lit(size), F.greatest(F.col("n") - 1, F.lit(size)), F.lit(settings.step))
    length = F.when(F.col("n") > size, size).otherwise(0)
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    origins = packed.withColumn("origin", F.explode(places)).repartition(slices, SERIES, "origin")
    windows = origins.where(F.coalesce(F.get("known", "origin"), F.col("n") <= size)).select(
        SERIES,
        F.get("dates", F.col("origin")).alias(DATE),
        F.get("y", F.col("origin")).alias("actual"),
        *[F.slice(c, F.col("origin") - size + 1, length).alias(c) for c in ("dates", "y", "known")],
        length.alias("n"),
    )
    run = run_models(fit_models(windows, models, settings), 1, settings)
    return run.select(SERIES, DATE, "model", "actual", F.get("run.forecast", F.lit(0)).alias("predicted"), "reason")


def rolling_backtest(df: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """Accuracy of the one-step forecasts over all origins, for every series and model."""
    return _accuracy_of_all(rolling_backtest_points(df, models, settings))


def forecast_kpis(forecast: DataFrame) -> DataFrame:
    """Totals, spread and wording of a forecast (series_id, step, forecast)."""
    value = F.col("forecast")
    out = forecast.groupBy(SERIES).agg(
        F.min_by(value, "step").alias("start_value"),
        F.max_by(value, "step").alias("end_value"),
        F.avg(value).alias("average_monthly"),
        F.sum(value).alias("total"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min_forecast"),
        F.max(value).alias("max_forecast"),
        F.max(F.when(F.col("step") == 7, value)).alias("_seventh"),
    )
    end, seventh = F.col("end_value"), F.col("_seventh")
    cv = ratio(F.col("std"), F.col("average_monthly"))
    swing = ratio(F.abs(F.col("max_forecast") - F.col("min_forecast")), F.col("average_monthly"))
    return out.withColumns(
        {
            "total_growth_pct": (ratio(end, F.col("start_value")) - 1) * 100,
            "cv_pct": cv * 100,
            "trajectory": F.when(end > seventh * 1.05, "Accelerating").when(end > seventh * 0.95, "Stable").otherwise("Declining"),
            "seasonality": F.when(swing > 0.1, "Detected").otherwise("Minimal"),
            "volatility": F.when(cv > 0.15, "High Volatility").when(cv > 0.08, "Moderate Volatility").otherwise("Low Volatility"),
        }
    ).drop("_seventh")


# --- Model store -----------------------------------------------------------------------------------


def fitted_parameters(df: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """The model store: parameters, AIC and in-sample accuracy per series and model."""
    return tournament(df, models, settings).select(
        SERIES, "model", "form", "params", "aic", "sse", "scores",
        F.col("end").alias("data_end_date"), "reason",
    )


def save_models(df: DataFrame, path: str, models=MODELS, settings: Forecasting = Forecasting()) -> None:
    fitted_parameters(df, models, settings).write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def score(df: DataFrame, stored: DataFrame, horizon: int, settings: Forecasting = Forecasting()) -> DataFrame:
    """Forecasts from stored parameters on a (possibly longer) history, without fitting again.

    A series without stored parameters, or too short for them, has one row without step and forecast, and the reason.
    """
    packed = pack_series(df)
    run = run_models(packed.join(stored.select(SERIES, "model", "form", "params"), SERIES, "left"), horizon, settings)
    reason = F.when(F.col("model").isNull(), "no parameters stored").when(F.col("run.forecast").isNull(), "too short for its parameters")
    return run.select(
        SERIES, "model", reason.alias("reason"), F.col("end").alias("_end"), F.posexplode_outer("run.forecast").alias("_k", "forecast")
    ).select(
        SERIES, "model", (F.col("_k") + 1).alias("step"),
        next_month_start(F.col("_end"), F.col("_k") + 1).alias(DATE), "forecast", "reason",
    )


def _last_known(packed: DataFrame) -> DataFrame:
    """The last month and value of every packed series beside it; that month is always a known one."""
    return packed.withColumns({"state_date": F.try_element_at("dates", F.lit(-1)), "state_value": F.try_element_at("y", F.lit(-1))})


def model_states(df: DataFrame, stored: DataFrame, settings: Forecasting = Forecasting()) -> DataFrame:
    """What has to be kept of each series to go on without its history: model, form and params as stored, and the model's state after the last known
    month (`state_date`, `state_value`): level, slope and season; the last changes, errors and values; the months so far.

    One replay of the history; null for a series without parameters or too short for them.
    """
    packed = _last_known(pack_series(df))
    run = run_models(packed.join(stored.select(SERIES, "model", "form", "params"), SERIES), 1, settings)
    return run.select(SERIES, "model", "form", "params", F.col("run.state").alias("state"), "state_date", "state_value")


def advance_states(states: DataFrame, new: DataFrame, horizon: int, settings: Forecasting = Forecasting()) -> tuple[DataFrame, DataFrame]:
    """States after the months of `new` that follow them, and (series, model, step, date, forecast, spread) from there on.

    Only the new months are read and folded in: nothing of the history before a state is. Months between a state and the first new one, and others
    without a value, lie on the line between their neighbours, or are integrated out, as in a replay; rows up to `state_date` are passed
    over. A series without new months keeps its state, one without a state is left out.
    """
    ends = states.where(F.col("state").isNotNull()).groupBy(SERIES).agg(F.max("state_date").alias("state_date"), F.max_by("state_value", "state_date").alias("state_value"))
    follow = new.join(ends.select(SERIES, "state_date"), SERIES).where(F.col(DATE) > F.col("state_date")).select(SERIES, DATE, "value")
    packed = _last_known(pack_series(follow.unionByName(ends.select(SERIES, F.col("state_date").alias(DATE), F.col("state_value").alias("value")))))
    after = packed.select(  # without the month that the states end with
        SERIES, *[F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))).alias(c) for c in ("dates", "y", "known")],
        (F.col("n") - 1).alias("n"), "end", "state_date", "state_value")
    run = cut(run_models(after.join(states.drop("state_date", "state_value").where(F.col("state").isNotNull()), SERIES), horizon, settings))
    later = run.select(SERIES, "model", "form", "params", F.col("run.state").alias("state"), "state_date", "state_value")
    ahead = run.select(SERIES, "model", "state_date", F.posexplode_outer(F.arrays_zip("run.forecast", "run.spread")).alias("_k", "_z"))
    step = F.col("_k") + 1
    return later, ahead.select(SERIES, "model", step.alias("step"), next_month_start(F.col("state_date"), step).alias(DATE), "_z.forecast", "_z.spread")
