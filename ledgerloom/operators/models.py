"""The candidate forecasting models: exponential smoothing, seasonal autoregression with moving averages, a bending line with yearly waves.

A series is packed into one row (an array of values, one for each month from its first known one to its last). Spark packs, deals out and
chooses; fitting and running step through the months of a batch of packed series at once, in NumPy (`functions.smoothing`,
`arima`, `waves`), which takes a small part of the time that recursions as array expressions took. Nothing is shuffled after
packing. Input to packing: one row per series and month, so an array is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import arima, smoothing, waves
from ledgerloom.functions.arrays import compute, number, steps
from ledgerloom.functions.padded import Padded, padded
from ledgerloom.params import DATE, SERIES, Forecasting

MODELS = ("ar", "ets", "fourier")


def pack_series(df: DataFrame, keys=(SERIES,), slices: int | None = None) -> DataFrame:
    """One row per series: dates and values of its months, which of them are `known`, their number, and the `end` that
    forecasts follow.

    Between known months values lie on a straight line, so that a month keeps its place in the season; months without a
    value at either end are left out. Of several values in a month the last counts. A series of nothing but gaps has empty arrays and ends with
    its last row. The number of partitions is given, not left to adaptive coalescing: the rows are few and small but the
    fits on them are long.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    point = F.when(F.col("value").isNotNull() & ~F.isnan("value"), F.struct(DATE, "value"))
    packed = (
        df.repartition(slices, *keys)
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_list(point)).alias("points"),
            F.count(F.lit(1)).alias("rows"),
            F.max(DATE).alias("end"),
        )
    )
    packed = compute(packed, {"months": MONTH_AXIS})
    return packed.select(
        *keys,
        F.transform("months", lambda p: p[DATE]).alias("dates"),
        F.transform("months", lambda p: p["value"]).alias("y"),
        F.transform("months", lambda p: p["known"]).alias("known"),
        F.size("months").alias("n"),
        F.col("rows").alias("rows"),
        F.coalesce(F.try_element_at("points", F.lit(-1))[DATE], F.col("end")).alias("end"),
    )


# Every known point, followed by the months up to the next one.
MONTH_AXIS = f"""flatten(transform(points, (p, i) -> get(transform(array(get(points, i + 1)), q -> get(transform(
    array((year(q.{DATE}) - year(p.{DATE})) * 12 + month(q.{DATE}) - month(p.{DATE})), gap -> case
        when q is null then array(named_struct('{DATE}', p.{DATE}, 'value', p.value, 'known', true))
        when gap < 1 then filter(array(named_struct('{DATE}', p.{DATE}, 'value', p.value, 'known', true)), x -> false)
        else transform(sequence(0, gap - 1), j -> named_struct('{DATE}', add_months(p.{DATE}, j),
            'value', p.value + (q.value - p.value) * j / gap, 'known', j = 0)) end), 0)), 0)))"""


# --- The models: each fits padded series and runs them from its parameters ---------------------------


def _aic(sse: np.ndarray, n: np.ndarray, k) -> np.ndarray:
    with np.errstate(all="ignore"):
        return n * np.log(np.maximum(sse / n, 1e-300)) + 2 * k


def _best(p: Padded, found: dict) -> list:
    """Of each series the candidate of least AIC as (form, params, aic, sse); a tie goes to the first, None where there is none.

    `found` holds (places, rows of parameters by name, aic, sse) by form.
    """
    out: list = [None] * len(p.y)
    for form, (places, params, aic, sse) in found.items():
        for i, place in enumerate(places.tolist()):
            if np.isfinite(aic[i]) and (out[place] is None or aic[i] < out[place][2]):
                out[place] = form, {k: float(v[i]) for k, v in params.items()}, float(aic[i]), float(sse[i])
    return out


def _fit_ets(p: Padded, s: Forecasting) -> list:
    """The form of least AIC, each with the weights of least squared error."""
    found = {}
    for form in s.ets_forms:
        places = np.flatnonzero(smoothing.usable(p, form, s.season))
        if len(places):
            q = p.pick(places)
            won, sse = smoothing.fit(q, form, s.season, s.grid)
            params = dict(zip(("alpha", "beta", "gamma"), won.T)) | {"sigma": np.sqrt(sse / q.n)}
            found[form] = places, params, _aic(sse, q.n, smoothing.size(form, s.season)), sse
    return _best(p, found)


def _run_ets(p: Padded, form: str, params: Callable, s: Forecasting, horizon: int, state):
    weights = np.stack([params("alpha"), params("beta"), params("gamma")], 1)
    before = state if state is None else (state[:, 0], state[:, 1], state[:, 2:])
    _, after, seen = smoothing.smooth(p, form, s.season, weights[:, None], before, path=True)
    level, slope, wave = after = [x[:, 0] for x in after]
    forecast, part = smoothing.ahead(form, s.season, after, horizon)
    return (seen[:, 0], forecast, smoothing.spread(form, s.season, after, weights, params("sigma"), horizon),
            np.concatenate([level[:, None], slope[:, None], wave], 1), part)


def _fit_ar(p: Padded, s: Forecasting) -> list:
    """The order of least AIC."""
    places = np.flatnonzero(p.n >= arima.least(s.season))
    found = {}
    if len(places):
        for form, order in arima.ORDERS.items():
            params, sse, aic, sigma = arima.fit(p.pick(places), order, s.season)
            found[form] = places, dict(zip(arima.PARAMS, params.T)) | {"sigma": sigma}, aic, sse
    return _best(p, found)


def _run_ar(p: Padded, form: str, params: Callable, s: Forecasting, horizon: int, state):
    return arima.run(p, np.stack([params(k) for k in arima.PARAMS], 1), params("sigma"), s.season, horizon, state)


def _fit_fourier(p: Padded, s: Forecasting) -> list:
    size = waves.size(s.fourier_pairs)
    places = np.flatnonzero(p.known.sum(1) > size + 1)
    if not len(places):
        return [None] * len(p.y)
    coef, penalty, sse, n, used = waves.fit(p.pick(places), s.fourier_pairs, s.knots, s.knot_penalties)
    params = {f"c{i}": c for i, c in enumerate(coef.T)} | {"penalty": penalty, "sigma": np.sqrt(sse / (n - used)), "months": p.n[places]}
    return _best(p, {f"trend+{s.fourier_pairs}": (places, params, _aic(sse, n, used + 1), sse)})


def _run_fourier(p: Padded, form: str, params: Callable, s: Forecasting, horizon: int, state):
    coef = np.stack([params(f"c{i}") for i in range(waves.size(s.fourier_pairs) + s.knots)], 1)
    return waves.run(p, coef, params("penalty"), params("sigma"), params("months"), s.fourier_pairs, s.knots, horizon, state)


_FIT = {"ar": _fit_ar, "ets": _fit_ets, "fourier": _fit_fourier}
_RUN = {"ar": _run_ar, "ets": _run_ets, "fourier": _run_fourier}


def least_months(model: str, settings: Forecasting) -> int:
    """The shortest series that a model is fitted to."""
    return {"ar": arima.least(settings.season), "ets": 2, "fourier": waves.size(settings.fourier_pairs) + 2}[model]


# --- Over packed series ------------------------------------------------------------------------------

_FITTED = "model string, form string, params map<string,double>, aic double, sse double, reason string"
_PARTS = ("fitted", "forecast", "spread", "state", "season")
RUN = "struct<" + ", ".join(f"{c}: array<double>" for c in _PARTS) + ">"


def fit_models(packed: DataFrame, models=MODELS, settings: Forecasting = Forecasting()) -> DataFrame:
    """Fitted parameters: one row per packed series and model, with model, form, params, aic, sse and reason beside its columns.

    Where a model cannot be fitted its row has nulls and says why: "too short" or "no unique fit". `params` holds the coefficients and `sigma`, the
    spread of one month's error, which is all that running needs beside the series.
    """
    least = {m: least_months(m, settings) for m in models}

    def run(stream):
        for batch in stream:
            fits: list = [[None] * batch.num_rows for _ in models]
            for p in padded(batch):
                for own, m in zip(fits, models):
                    for place, fitted in zip(p.rows.tolist(), _FIT[m](p, settings)):
                        own[place] = fitted
            months = batch["known"].to_pylist() if "fourier" in models else [()] * batch.num_rows
            rows = np.repeat(np.arange(batch.num_rows), len(models))
            made = [(m, own[i]) for i in range(batch.num_rows) for own, m in zip(fits, models)]
            size = [sum(months[i]) if m == "fourier" else n for i, n in enumerate(batch["n"].to_pylist()) for m in models]
            form, params, aic, sse = zip(*[f or (None,) * 4 for _, f in made]) if made else ((),) * 4
            reason = [None if f else "too short" if n < least[m] else "no unique fit" for (m, f), n in zip(made, size)]
            columns = [pa.array([m for m, _ in made], pa.string()), pa.array(form, pa.string()),
                       pa.array([x and list(x.items()) for x in params], pa.map_(pa.string(), pa.float64())),
                       pa.array(aic, pa.float64()), pa.array(sse, pa.float64()), pa.array(reason, pa.string())]
            carried = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*carried.columns, *columns], names=[*batch.schema.names, "model", "form", "params", "aic", "sse", "reason"])

    return packed.mapInArrow(run, T.StructType([*packed.schema.fields, *T.StructType.fromDDL(_FITTED).fields]))


def run_models(fitted: DataFrame, horizon: int, settings: Forecasting = Forecasting()) -> DataFrame:
    """Add `run` to rows holding a packed series and a model's parameters: fitted values, forecast, the spread of each forecast's error, the
    state after the last month, from which `run_models` goes on, and the season's part of each forecast, where the model tells it apart.

    The parameters may come straight from `fit_models` or from a stored table joined to packed series. Where they are null, or the series is too short
    for the model, `run` is null. Where the rows have a `state`, the packed series holds only the months that follow on from it, perhaps none.
    """
    carried = "state" in fitted.columns

    def run(stream):
        for batch in stream:
            made: list = [None] * batch.num_rows
            model, form = np.array(batch["model"].to_pylist(), object), np.array(batch["form"].to_pylist(), object)
            params = [x and dict(x) for x in batch["params"].to_pylist()]
            before = batch["state"].to_pylist() if carried else None
            for p in padded(batch):
                for kind in {(m, f) for m, f in zip(model[p.rows], form[p.rows]) if m is not None and f is not None}:
                    ready = [model[r] == kind[0] and form[r] == kind[1] and (before[r] is not None if carried else p.n[i] >= _run_least(*kind, settings))
                             for i, r in enumerate(p.rows)]
                    q = p.pick(np.flatnonzero(ready))
                    if not len(q.rows):
                        continue
                    of = [params[r] for r in q.rows]
                    state = np.array([before[r] for r in q.rows], float) if carried else None
                    results = _RUN[kind[0]](q, kind[1], lambda k, of=of: np.array([x.get(k, 0.0) for x in of], float), settings, horizon, state)
                    for i, r in enumerate(q.rows.tolist()):
                        seen, *others = (x[i] for x in results)
                        made[r] = dict(zip(_PARTS, map(_nullable, (seen[: q.n[i]], *others))))
            column = pa.array(made, pa.struct([(k, pa.list_(pa.float64())) for k in _PARTS]))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "run"])

    return fitted.mapInArrow(run, T.StructType([*fitted.schema.fields, *T.StructType.fromDDL(f"run {RUN}").fields]))


def _run_least(model: str, form: str, settings: Forecasting) -> int:
    if model == "ets":
        return 2 if form[2] == "N" else 2 * settings.season
    return arima.least(settings.season) if model == "ar" else 1


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=np.isnan(values)).to_pylist()


def trend_line(horizon: int, recent: int = 12, default: float = 3_000_000.0) -> str:
    """The trend forecast (see `series.trend_forecast`) of a packed series, as an array."""
    size = f"least(n, {recent})"
    total = f"aggregate(last12, 0D, (_s, _v) -> _s + _v)"
    centre = f"(({size} - 1) / 2D)"
    spread = f"({size} * ({size} * {size} - 1) / 12D)"
    slope = f"try_divide(aggregate(transform(last12, (_v, _i) -> _v * (_i - {centre})), 0D, (_s, _v) -> _s + _v), {spread})"
    line = f"greatest({total} / {size} + ({slope}) * ({size} - 1 + k - {centre}), 0.5D * element_at(last12, -1))"
    start = f"if(rows < 2, {number(default)}, coalesce(get(last12, n - 1), {number(default)}))"
    steps_ = steps(1, horizon)
    body = f"if(rows >= 2 and n >= 2, transform({steps_}, k -> {line}), transform({steps_}, k -> {start} * pow(1.02D, k - 1)))"
    return f"get(transform(array(slice(y, greatest(n - {recent - 1}, 1), {recent})), last12 -> {body}), 0)"
