"""The plan replayed under named scenarios, all of them in one query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import windows as w
from ledgerloom.functions.numeric import ratio
from ledgerloom.operators.planning import RATE, default_opex, financial_plan, plan_metrics
from ledgerloom.params import SCENARIOS, SERIES, STRESS_TESTS, Finance
from ledgerloom.sources.scenarios import scenario_array

KEYS = (SERIES, "scenario")
BASELINE_RATE = "base_rate"


def apply_scenarios(forecast: DataFrame, scenarios=SCENARIOS, finance: Finance = Finance()) -> DataFrame:
    """Each forecast row once per scenario, with sales, opex and FX shifted in level.

    The scenarios are a literal array exploded beside each row: no join, and rows stay where they are.
    """
    df = forecast.select("*", F.inline(scenario_array(scenarios)))
    df = df.withColumn("sales", F.col("sales") * (1 + F.col("sales_change")))
    if "opex" not in df.columns:
        df = default_opex(df, KEYS, finance)
    base = F.col(RATE) if RATE in df.columns else F.lit(finance.default_fx)
    df = df.withColumn("opex", F.col("opex") * (1 + F.col("opex_change"))).withColumn(BASELINE_RATE, base)
    return df.withColumn(RATE, F.col(BASELINE_RATE) * (1 + F.col("fx_change")))


def run_scenarios(
    forecast: DataFrame, scenarios=SCENARIOS, finance: Finance = Finance(), fx_anchor: str = "scenario"
) -> DataFrame:
    """The full plan per series and scenario.

    `fx_anchor="scenario"` holds FX against the scenario's own first rate, so a level shock leaves cost of
    goods alone; `"baseline"` holds it against the unshocked first rate.
    """
    anchor = {"scenario": RATE, "baseline": BASELINE_RATE}[fx_anchor]
    adjusted = apply_scenarios(forecast, scenarios, finance)
    plan = financial_plan(adjusted, KEYS, finance, anchor)
    return plan.drop("sales_change", "fx_change", "opex_change", BASELINE_RATE)


def scenario_comparison(plans: DataFrame, base: str = "base") -> DataFrame:
    """Metrics of each scenario, with sales and cash flow against the base scenario where there is one."""
    metrics = plan_metrics(plans, KEYS)
    span = w.whole()

    def of_base(c):
        return F.max(F.when(F.col("scenario") == base, F.col(c))).over(span)

    return metrics.select(
        *KEYS,
        "total_sales",
        F.col("total_free_cash_flow").alias("total_fcf"),
        F.col("gross_margin_percent").alias("gross_margin_pct"),
        F.col("ebit_margin_percent").alias("ebit_margin_pct"),
        F.col("minimum_fcf").alias("min_fcf"),
        "fcf_volatility",
        ((ratio(F.col("total_sales"), of_base("total_sales")) - 1) * 100).alias("sales_vs_base_pct"),
        ((ratio(F.col("total_free_cash_flow"), of_base("total_free_cash_flow")) - 1) * 100).alias("fcf_vs_base_pct"),
    )


def scenario_insights(comparison: DataFrame, base: str = "base") -> DataFrame:
    """Best and worst scenario, the range between them against the base, and which lose cash in some month."""
    total = F.col("total_fcf")
    out = comparison.groupBy(SERIES).agg(
        F.max_by("scenario", F.struct(total, "scenario")).alias("best_case_scenario"),
        F.min_by("scenario", F.struct(total, "scenario")).alias("worst_case_scenario"),
        (F.max(total) - F.min(total)).alias("fcf_range"),
        F.coalesce(F.max(F.when(F.col("scenario") == base, total)), F.avg(total)).alias("_base"),
        F.array_sort(F.collect_list(F.when(F.col("min_fcf") < 0, F.col("scenario")))).alias("scenarios_with_negative_fcf"),
    )
    risk = ratio(F.col("fcf_range"), F.col("_base")) * 100
    level = F.when(risk > 50, "High").when(risk > 25, "Medium").otherwise("Low")
    return out.withColumns({"risk_percentage": risk, "risk_level": level}).drop("_base")


def scenario_summary(plans: DataFrame, scenario: str) -> DataFrame:
    """The metrics of one scenario per series, with its mean monthly cash flow."""
    chosen = plans.filter(F.col("scenario") == scenario)
    metrics = plan_metrics(chosen, (*KEYS, "scenario_description"))
    return metrics.select(
        SERIES,
        F.col("scenario").alias("scenario_name"),
        F.col("scenario_description").alias("description"),
        "total_sales", "total_free_cash_flow",
        ratio(F.col("total_free_cash_flow"), F.col("periods")).alias("avg_monthly_fcf"),
        "gross_margin_percent", "ebit_margin_percent",
        F.col("minimum_fcf").alias("minimum_monthly_fcf"),
        "fcf_volatility",
    )


def stress_tests(
    forecast: DataFrame, tests=STRESS_TESTS, finance: Finance = Finance(), fx_anchor: str = "scenario"
) -> DataFrame:
    """Total and least monthly cash flow under fixed shocks to sales and FX; opex follows the shocked sales."""
    bare = forecast.drop("opex", RATE)
    anchor = {"scenario": RATE, "baseline": BASELINE_RATE}[fx_anchor]
    plans = financial_plan(apply_scenarios(bare, tests, finance), KEYS, finance, anchor)
    return plans.groupBy(*KEYS).agg(
        F.sum("free_cash_flow").alias("total_fcf"),
        F.min("free_cash_flow").alias("min_monthly_fcf"),
        F.first("sales_change").alias("sales_impact"),
        F.first("fx_change").alias("fx_impact"),
    )
