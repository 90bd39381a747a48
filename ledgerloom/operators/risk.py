"""Monte Carlo risk of a plan: simulated shocks, cash-flow totals and their distribution.

A series is one row holding its forecast as arrays. Simulations are spread in two steps: the row is copied
once per block of simulations and the blocks are dealt out over the cluster, then each block unfolds into its
simulations in place. A single series therefore uses every core, and only short rows are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import draws
from ledgerloom.functions.arrays import compute, number, total
from ledgerloom.functions.numeric import chi2_two_tail, finite, omnibus_k2, ratio
from ledgerloom.functions.quantiles import add_quantiles, exact_quantiles
from ledgerloom.operators.cleaning import sanitize_forecast
from ledgerloom.operators.planning import RATE
from ledgerloom.params import DATE, SERIES, Finance, Risk

BLOCK = 250
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def _slices(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pack_forecast(forecast: DataFrame, finance: Finance = Finance()) -> DataFrame:
    """One row per series: sales (made usable), and opex and FX where given, as arrays by period."""
    carried = [c for c in ("opex", RATE) if c in forecast.columns]
    usable = sanitize_forecast(forecast.select(SERIES, DATE, "sales", *carried), finance=finance)
    points = F.array_sort(F.collect_list(F.struct(DATE, "sales", *carried)))
    packed = usable.groupBy(SERIES).agg(points.alias("p"))
    return packed.select(
        SERIES, F.size("p").alias("periods"), *[F.col("p")[c].alias(c) for c in ("sales", *carried)]
    )


def spread_simulations(packed: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Each packed row once per simulation, `sim_id` counting from 0."""
    blocks = math.ceil(risk.runs / BLOCK)
    dealt = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")).repartition(
        _slices(packed), SERIES, "_block"
    )
    last = F.least(F.lit(risk.runs), (F.col("_block") + 1) * BLOCK) - 1
    return dealt.withColumn("sim_id", F.explode(F.sequence(F.col("_block") * BLOCK, last))).drop("_block")


def standard_normals(packed: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The draws behind the shocks, one row per series, simulation and period."""
    pairs = draws.normal_pairs(risk.seed, SERIES, "sim_id", "periods")
    drawn = spread_simulations(packed.select(SERIES, "periods"), risk)
    return drawn.select(SERIES, "sim_id", F.posexplode_outer(F.expr(pairs)).alias("_k", "z")).select(
        SERIES, "sim_id", (F.col("_k") + 1).alias("period"), F.col("z.sales").alias("z_sales"), F.col("z.fx").alias("z_fx")
    )


def _ar1(z: str, carry: float, vol: float) -> str:
    """A first-order autoregression with the given total spread, from standard normals."""
    rest = vol * math.sqrt(1.0 - carry * carry)
    return f"""aggregate({z}, cast(array() as array<double>), (a, v) -> concat(a, array(if(size(a) = 0,
        {number(vol)} * v, {number(carry)} * element_at(a, -1) + {number(rest)} * v))))"""


def with_draws(simulations: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Add `draws`, both shocks' normals by period, from one hash for each period."""
    return compute(simulations, {"draws": draws.normal_pairs(risk.seed, SERIES, "sim_id", "periods")})


def sales_shocks(simulations: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Sales shocks, from `draws` where they are there."""
    drawn = "draws" in simulations.columns
    z = "transform(draws, q -> q.sales)" if drawn else draws.normals(risk.seed, SERIES, "sim_id", "periods", "sales")
    return compute(simulations, {"sales_shock": _ar1(z, risk.sales_ar, risk.sales_vol)})


def fx_shocks(simulations: DataFrame, risk: Risk = Risk(), correlated: bool = False) -> DataFrame:
    """FX shocks, from `draws` where they are there; with `correlated`, theirs lean on the sales draws by the given correlation."""
    drawn = "draws" in simulations.columns
    if correlated:
        pairs = "draws" if drawn else draws.normal_pairs(risk.seed, SERIES, "sim_id", "periods")
        own = math.sqrt(1.0 - risk.correlation**2)
        z = f"transform({pairs}, q -> {number(risk.correlation)} * q.sales + {number(own)} * q.fx)"
    else:
        z = "transform(draws, q -> q.fx)" if drawn else draws.normals(risk.seed, SERIES, "sim_id", "periods", "fx")
    return compute(simulations, {"fx_shock": _ar1(z, risk.fx_ar, risk.fx_vol)})


def apply_fx_shocks(simulations: DataFrame, column: str = RATE) -> DataFrame:
    """Shocked FX beside the given one (`base_rate`)."""
    rest = [c for c in simulations.columns if c != column]
    renamed = simulations.select(*rest, F.col(column).alias("base_rate"))
    return compute(renamed, {column: "zip_with(base_rate, fx_shock, (rate, s) -> rate * (1D + s))"})


def simulate_plans(
    forecast: DataFrame,
    risk: Risk = Risk(),
    finance: Finance = Finance(),
    correlated: bool = False,
    fx_anchor: str = "scenario",
) -> DataFrame:
    """Total cash flow, total operating result and least monthly cash flow of every simulated plan.

    Without a given FX path the FX shocks have nothing to act on and are not drawn. `fx_anchor="baseline"`
    holds FX against its unshocked first rate.
    """
    packed = pack_forecast(forecast, finance)
    sims = spread_simulations(packed, risk)
    sims = sales_shocks(with_draws(sims, risk) if RATE in packed.columns else sims, risk)
    drift = "0D"
    if RATE in packed.columns:
        sims = apply_fx_shocks(fx_shocks(sims, risk, correlated))
        anchor = {"scenario": RATE, "baseline": "base_rate"}[fx_anchor]
        drift = f"(try_divide(get({RATE}, k), get({anchor}, 0)) - 1D)"
    shocked = "zip_with(sales, sales_shock, (v, s) -> v * (1D + s))"
    floor = number(finance.floor_sales)
    sims = compute(sims, {"_raw": shocked})
    sims = compute(sims, {"_sales": f"if(array_min(_raw) <= 0D, transform(_raw, v -> greatest(v, {floor})), _raw)"})
    opex = "get(opex, k)" if "opex" in packed.columns else (
        f"get(_sales, 0) * {number(finance.opex_share)} * pow({number(1.0 + finance.opex_step)}, k)"
    )
    cogs = f"(v * {number(finance.cogs_share)} * (1D + {number(finance.beta_fx)} * {drift}))"
    bound = (
        f"v * {number(finance.dso)} / 30D + {cogs} * {number(finance.dio)} / 30D - {cogs} * {number(finance.dpo)} / 30D"
    )
    sims = compute(
        sims, {"_plan": f"transform(_sales, (v, k) -> named_struct('ebit', v - {cogs} - {opex}, 'wc', {bound}))"}
    )
    flow = f"""transform(_plan, (p, k) -> p.ebit - greatest(0D, p.ebit * {number(finance.tax_rate)})
        + {number(finance.depreciation)} - {number(finance.capex)} - if(k = 0, 0D, p.wc - get(_plan, k - 1).wc))"""
    sims = compute(sims, {"_flow": flow, "total_ebit": "aggregate(_plan, 0D, (s, p) -> s + p.ebit)"})
    sims = compute(sims, {"total_fcf": total("_flow"), "min_monthly_fcf": "array_min(_flow)"})
    return sims.select(SERIES, "sim_id", "total_fcf", "total_ebit", "min_monthly_fcf")


def winsorize_tails(sims: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Bound the totals by two of their own quantiles. Reads the simulations more than once: cut them first."""
    ends = {"total_fcf": "_fcf", "total_ebit": "_ebit"}
    sims = add_quantiles(sims, SERIES, ends, (risk.lower_tail, risk.upper_tail))
    bounded = {c: F.greatest(F.least(F.col(c), F.col(q)[1]), F.col(q)[0]) for c, q in ends.items()}
    return sims.withColumns(bounded).drop(*ends.values())


def with_value_at_risk(sims: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Beside each simulation, the totals that are undercut with probability 1 - confidence. Reads the simulations more than once: cut them first."""
    marks = {"total_fcf": "fcf_var", "total_ebit": "ebit_var"}
    sims = add_quantiles(sims, SERIES, marks, (1.0 - risk.confidence,))
    return sims.withColumns({name: F.col(name)[0] for name in marks.values()})


def var_cvar(sims: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Value at risk, expected shortfall and spread of the simulated totals (population std)."""

    def shortfall(c):
        return F.avg(F.when(F.col(f"total_{c}") <= F.col(f"{c}_var"), F.col(f"total_{c}")))

    fcf = F.col("total_fcf")
    out = with_value_at_risk(sims, risk).groupBy(SERIES).agg(
        F.first("fcf_var").alias("fcf_var_95"),
        shortfall("fcf").alias("fcf_cvar_95"),
        F.first("ebit_var").alias("ebit_var_95"),
        shortfall("ebit").alias("ebit_cvar_95"),
        F.avg(fcf).alias("fcf_mean"),
        F.stddev_pop(fcf).alias("fcf_std"),
        F.min(fcf).alias("fcf_min"),
        F.max(fcf).alias("fcf_max"),
        *_loss_shares(),
    )
    return out.withColumn("fcf_coefficient_of_variation", ratio(F.col("fcf_std"), F.col("fcf_mean")))


def _loss_shares():
    return (
        F.avg((F.col("min_monthly_fcf") < 0).cast("double")).alias("prob_negative_monthly_fcf"),
        F.avg((F.col("total_fcf") < 0).cast("double")).alias("prob_negative_total_fcf"),
    )


def loss_probability(sims: DataFrame) -> DataFrame:
    """Shares of simulations with a negative month, and with a negative total."""
    return sims.groupBy(SERIES).agg(*_loss_shares())


def _named_percentiles(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns({f"p{p}": F.col(column)[i] for i, p in enumerate(PERCENTILES)}).drop(column)


def _moments(column: str):
    return (
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_pop(column).alias("std"),
        finite(F.skewness(column)).alias("skewness"),
        finite(F.kurtosis(column)).alias("kurtosis"),
    )


def distribution_percentiles(sims: DataFrame, column: str = "total_fcf") -> DataFrame:
    return _named_percentiles(exact_quantiles(sims, SERIES, column, [p / 100.0 for p in PERCENTILES]), "quantiles")


def distribution_moments(sims: DataFrame, column: str = "total_fcf") -> DataFrame:
    """Mean, population std, skewness and excess kurtosis of the totals."""
    return sims.groupBy(SERIES).agg(*_moments(column))


def normality_test(moments: DataFrame) -> DataFrame:
    """D'Agostino-Pearson test on `distribution_moments`; normal where p lies above 0.05."""
    k2 = omnibus_k2(F.col("n"), F.col("skewness"), F.col("kurtosis"))
    p = chi2_two_tail(F.col("k2"))
    return moments.withColumn("k2", k2).withColumn("normality_p_value", p).withColumn(
        "is_normal", F.coalesce(F.col("normality_p_value") > 0.05, F.lit(False))
    )


def risk_summary(metrics: DataFrame) -> DataFrame:
    """The risk level in a word, and the figures an executive reads; needs `var_cvar`."""
    cv, loss = F.col("fcf_coefficient_of_variation"), F.col("prob_negative_total_fcf")
    # A mean of zero leaves the variation infinite.
    wide = F.coalesce(cv, F.lit(float("inf")))
    level = F.when((wide > 0.5) | (loss > 0.2), "High").when((wide > 0.3) | (loss > 0.1), "Medium").otherwise("Low")
    return metrics.select(
        SERIES,
        level.alias("overall_risk_level"),
        F.col("fcf_mean").alias("expected_total_fcf"),
        F.col("fcf_var_95").alias("worst_case_5pct"),
        F.col("fcf_cvar_95").alias("expected_shortfall"),
        F.col("prob_negative_total_fcf").alias("probability_of_loss"),
        F.col("fcf_std").alias("volatility"),
        F.coalesce(ratio(F.col("fcf_mean"), F.col("fcf_std")), F.lit(0.0)).alias("risk_adjusted_return"),
    )


def distribution_report(sims: DataFrame, column: str = "total_fcf") -> DataFrame:
    """Percentiles, moments and normality of one simulated total; both parts have one row per series."""
    moments = normality_test(distribution_moments(sims, column))
    return distribution_percentiles(sims, column).join(moments, SERIES)
