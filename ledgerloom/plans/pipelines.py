"""Whole jobs: from a ledger to forecasts, plans, scenarios and risk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import feeds, profiling as p, risk as r
from ledgerloom.operators.cleaning import prepare_ledger, repair_ledger
from ledgerloom.operators.features import add_growth, calendar_flags, forecast_growth, optional_features
from ledgerloom.operators.forecasting import forecast_horizon, forecast_kpis
from ledgerloom.operators.planning import RATE, financial_plan, plan_metrics
from ledgerloom.operators.quality import integrity_report, quality_flags, rule_predicates
from ledgerloom.operators.scenarios import run_scenarios, scenario_comparison, scenario_insights, stress_tests
from ledgerloom.operators.series import stationarity, trend_forecasts
from ledgerloom.params import DATE, FX, OPEX, RANDOM_SEED, SALES, SCENARIOS, SERIES, LedgerError, Settings
from ledgerloom.plans.lineage import cut
from ledgerloom.sources.readers import MALFORMED, standardize_schema
from ledgerloom.sources.rollup import extract_series, first_counted
from ledgerloom.sources.sinks import nest_report


@dataclass(frozen=True)
class Ingested:
    ledger: DataFrame
    counts: DataFrame


def ingest(raw: DataFrame, settings: Settings = Settings(), tie_break: str | None = None) -> Ingested:
    """A loose ledger reduced to one typed row per series and date, and what was found on the way, from one pass over the source.

    `counts` has a row per series: raw_rows, undated_rows (left out of the ledger), malformed_rows (of `readers.read_text`), repeated_rows (left out
    as another row of their date is kept) and the dated rows that break each rule. The reduced rows carry their counts and are written to the shared folder; both results
    read them there.
    """
    typed = standardize_schema(raw, drop_undated=False)
    malformed = F.col(MALFORMED) if MALFORMED in typed.columns else F.lit(False)
    dated = F.col(DATE).isNotNull()
    counted = {"malformed_rows": malformed, **{name: dated & broken for name, broken in rule_predicates(settings.rules).items()}}
    reduced = cut(first_counted(typed, counted, tie_break))
    dated_rows = F.sum(F.when(dated, F.col("raw_rows")).otherwise(0))
    counts = reduced.groupBy(SERIES).agg(
        F.sum("raw_rows").alias("raw_rows"), (F.sum("raw_rows") - dated_rows).alias("undated_rows"),
        F.sum("malformed_rows").alias("malformed_rows"), (dated_rows - F.count(DATE)).alias("repeated_rows"),
        *[F.sum(name).alias(name) for name in rule_predicates(settings.rules)])
    return Ingested(reduced.where(dated).drop("raw_rows", *counted, MALFORMED), counts)


def load_ledger(raw: DataFrame, settings: Settings = Settings(), strict: bool = True) -> DataFrame:
    """Validate, reduce to one row per date, fill, and add calendar and growth columns.

    The source is read once. Strict mode adds up the broken rules that `ingest` counted and raises on any.
    """
    ingested = ingest(raw, settings)
    if strict:
        names = list(rule_predicates(settings.rules))
        totals = ingested.counts.agg(*[F.sum(n).alias(n) for n in names]).first().asDict()
        broken = {k: v for k, v in totals.items() if v}
        if broken:
            raise LedgerError(f"rows break validation rules: {broken}")
    return calendar_flags(add_growth(prepare_ledger(ingested.ledger)))


@dataclass(frozen=True)
class Cleaned:
    ledger: DataFrame
    report: DataFrame
    counts: DataFrame


def clean_job(raw: DataFrame, settings: Settings = Settings(), tie_break: str | None = None, seed: int | None = RANDOM_SEED) -> Cleaned:
    """A loose ledger typed, reduced, repaired over the calendar and given every explanatory column; its integrity report; and what was found in the source."""
    ingested = ingest(raw, settings, tie_break)
    keep = [c for c in ingested.ledger.columns if c != tie_break]
    repaired = optional_features(repair_ledger(ingested.ledger.select(keep), settings.rules), settings.finance, seed)
    flagged = cut(quality_flags(repaired))
    return Cleaned(flagged, integrity_report(flagged), ingested.counts)


@dataclass(frozen=True)
class Profile:
    sections: dict[str, DataFrame]
    report: DataFrame


def profile_job(ledger: DataFrame) -> Profile:
    """Every profile that has one row per series, by section, and all of them in one row per series as `report`.

    `ledger` has one row per series and date. Growth and rolling volatility are computed once and read by all sections.
    """
    grown = cut(p.add_rolling_volatility(add_growth(ledger)))
    months = p.month_profile(grown).groupBy(SERIES).agg(F.first("peak_month").alias("peak_month"), F.first("trough_month").alias("trough_month"))
    quarters = p.quarter_profile(grown).groupBy(SERIES).agg(F.first("q4_premium").alias("q4_premium"))
    sections = {
        "growth": p.growth_stats(grown), "trend": p.linear_trend(grown), "months": months, "quarters": quarters, "year_end": p.year_end_effect(grown),
        "annual": p.annual_growth(grown),
        "strength": p.detrended_strength(grown), "consistency": p.growth_consistency(grown), "correlation": p.correlation_matrix(grown),
        "volatility": p.rolling_volatility(grown), "clusters": p.volatility_clusters(grown), "persistence": p.volatility_persistence(grown),
        "sensitivity": p.sensitivity_labels(grown), "stationarity": stationarity(extract_series(grown, SALES)),
    }
    return Profile(sections, nest_report(sections))


@dataclass(frozen=True)
class RiskStudy:
    simulations: DataFrame
    metrics: DataFrame
    summary: DataFrame
    distribution: DataFrame
    stress: DataFrame


def risk_job(sales: DataFrame, settings: Settings = Settings()) -> RiskStudy:
    """Simulated plans of a forecast (series_id, date, sales), their risk figures, the shape of their distribution, and the stress tests."""
    sales = cut(sales)
    simulations = cut(r.simulate_plans(sales, settings.risk, settings.finance))
    metrics = r.var_cvar(simulations, settings.risk)
    return RiskStudy(simulations, metrics, r.risk_summary(metrics), r.distribution_report(simulations), stress_tests(sales, finance=settings.finance))


def forecast_measures(ledger: DataFrame, horizon: int) -> DataFrame:
    """Sales, opex and FX carried forward by their trend lines, as plan input."""
    return trend_forecasts(ledger, {"sales": SALES, "opex": OPEX, RATE: FX}, horizon)


def forecast_job(ledger: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Best forecast of sales with growth columns, and its key figures."""
    ahead = forecast_horizon(extract_series(ledger, SALES), settings=settings.forecasting)
    return forecast_growth(ahead), forecast_kpis(ahead)


@dataclass(frozen=True)
class PlanResult:
    forecast: DataFrame
    plans: DataFrame
    comparison: DataFrame
    insights: DataFrame
    simulations: DataFrame
    risk: DataFrame
    kpis: DataFrame


def plan_job(ledger: DataFrame, settings: Settings = Settings(), scenarios=SCENARIOS) -> PlanResult:
    """Forecast, plan under every scenario, risk study and the executive figures.

    The forecast and the simulated totals are read by several results, so their lineage is cut: two jobs run while the
    results are built, and models and simulations are computed once.
    """
    ahead = forecast_horizon(extract_series(ledger, SALES), settings=settings.forecasting)
    sales = ahead.select(SERIES, DATE, F.col("forecast").alias("sales"))
    return plan_from_forecast(sales, settings, scenarios)


def plan_from_forecast(sales: DataFrame, settings: Settings = Settings(), scenarios=SCENARIOS) -> PlanResult:
    """The same from a given sales forecast (series_id, date, sales)."""
    sales = cut(sales)
    plans = run_scenarios(sales, scenarios, settings.finance)
    comparison = scenario_comparison(plans)
    insights = scenario_insights(comparison)
    simulations = cut(r.simulate_plans(sales, settings.risk, settings.finance))
    metrics = r.var_cvar(simulations, settings.risk)
    base = plan_metrics(financial_plan(sales, finance=settings.finance))
    kpis = feeds.executive_kpis(base, r.risk_summary(metrics), insights)
    return PlanResult(sales, plans, comparison, insights, simulations, metrics, kpis)
