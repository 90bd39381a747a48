"""Published reference results: the plan, its scenarios and the normality figures."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import planning as p
from ledgerloom.operators import scenarios as s
from ledgerloom.operators.risk import normality_test
from ledgerloom.params import Finance, LedgerError, select_scenarios
from ledgerloom.sources.sinks import round_numbers
from tests.conftest import month

# The published twelve-month base forecast, and the totals that follow from it.
BASE_SALES = [
    4301913.99, 4298077.66, 4295747.52, 4308341.4, 4372655.64, 4439425.54,
    4491886.85, 4493569.25, 4494493.57, 4496194.67, 4498726.24, 4500073.11,
]
TOTAL_FCF = {
    "base": 2758568.64, "optimistic": 4399357.89, "best": 3753724.13, "moderate_growth": 3257984.49,
    "fx_shock": 2590640.22, "cost_cut": 3528863.02, "recession": 2167537.88, "stress": 1830487.84,
    "recovery": 3741252.42,
}
MIN_FCF = {
    "base": 27817.88, "optimistic": 133357.83, "best": 92289.65, "moderate_growth": 58835.93, "fx_shock": 23926.99,
    "cost_cut": 116249.54, "recession": -1721.66, "stress": -15293.05, "recovery": 82457.44,
}
FCF_VOLATILITY = {"base": 137454.04216281962, "stress": 113417.85033113832, "optimistic": 161117.66418004452}
FCF_VS_BASE = {"optimistic": 59.47973257609425, "stress": -33.64356378676152, "recovery": 35.622959158993424}


@pytest.fixture(scope="module")
def forecast(spark):
    rows = [("a", month(10 + i, 2025), v) for i, v in enumerate(BASE_SALES)]
    return spark.createDataFrame(rows, "series_id string, date date, sales double")


@pytest.fixture(scope="module")
def comparison(forecast):
    return {r["scenario"]: r for r in s.scenario_comparison(round_numbers(s.run_scenarios(forecast))).collect()}


def test_base_plan_first_and_last_rows(forecast):
    rows = round_numbers(p.financial_plan(forecast)).orderBy("date").collect()
    first, last = rows[0], rows[-1]
    assert first["cogs"] == 2796244.09 or first["cogs"] == 2796244.1
    assert first["opex"] == pytest.approx(860382.8, abs=0.02)
    assert first["tax"] == pytest.approx(141963.16, abs=0.02)
    assert first["wc_change"] == 0.0
    assert first["free_cash_flow"] == pytest.approx(453323.94, abs=0.02)
    assert last["opex"] == pytest.approx(1471546.56, abs=0.02)
    assert last["working_capital"] == pytest.approx(9675157.18, abs=0.02)
    assert last["free_cash_flow"] == pytest.approx(27817.88, abs=0.02)
    assert [c for c in p.PLAN_COLUMNS] == p.financial_plan(forecast).columns[1:]


def test_scenarios_match_published_totals(comparison):
    assert set(comparison) == set(TOTAL_FCF)
    for name, row in comparison.items():
        assert row["total_fcf"] == pytest.approx(TOTAL_FCF[name], abs=0.1)
        assert row["min_fcf"] == pytest.approx(MIN_FCF[name], abs=0.02)
        assert row["gross_margin_pct"] == pytest.approx(35.0, abs=1e-6)
    for name, v in FCF_VOLATILITY.items():
        assert comparison[name]["fcf_volatility"] == pytest.approx(v, rel=1e-6)
    for name, v in FCF_VS_BASE.items():
        assert comparison[name]["fcf_vs_base_pct"] == pytest.approx(v, rel=1e-6)


def test_insights_match_published(forecast):
    row = s.scenario_insights(s.scenario_comparison(s.run_scenarios(forecast))).first()
    assert (row["best_case_scenario"], row["worst_case_scenario"]) == ("optimistic", "stress")
    assert row["fcf_range"] == pytest.approx(2568870.05, abs=0.2)
    assert row["risk_percentage"] == pytest.approx(93.12329636285578, rel=1e-6)
    assert row["scenarios_with_negative_fcf"] == ["recession", "stress"]
    assert row["risk_level"] == "High"


def test_base_scenario_equals_the_plan(forecast):
    plan = p.financial_plan(forecast).select("date", "free_cash_flow").collect()
    base = s.run_scenarios(forecast).filter("scenario = 'base'").select("date", "free_cash_flow").collect()
    assert sorted(plan) == sorted(base)


def test_arithmetic(spark):
    df = spark.createDataFrame(
        [("a", month(0), 1e6, 2e5, 30.0), ("a", month(1), 1.1e6, 2.2e5, 32.0)],
        "series_id string, date date, sales double, opex double, usdtry_rate double",
    )
    first, second = p.financial_plan(df).orderBy("date").collect()
    assert (first["cogs"], first["gross_profit"], first["ebit"]) == (650000.0, 350000.0, 150000.0)
    assert (first["accounts_receivable"], first["accounts_payable"], first["inventory"]) == (1.5e6, 650000.0, 1.3e6)
    assert second["cogs"] == pytest.approx(1.1e6 * 0.65 * (1 + 0.15 * (32 / 30 - 1)))
    assert second["wc_change"] == pytest.approx(second["working_capital"] - first["working_capital"])


def test_no_tax_on_a_loss_and_shock_anchor(spark):
    df = spark.createDataFrame(
        [("a", month(0), 1e6, 5e6, 30.0)], "series_id string, date date, sales double, opex double, usdtry_rate double"
    )
    assert p.financial_plan(df).first()["tax"] == 0.0
    own = s.run_scenarios(df).filter("scenario = 'fx_shock'").first()["cogs"]
    against_base = s.run_scenarios(df, fx_anchor="baseline").filter("scenario = 'fx_shock'").first()["cogs"]
    assert own == pytest.approx(950000 * 0.65)
    assert against_base == pytest.approx(950000 * 0.65 * 1.03)


def test_stress_adjustment_and_unknown_scenario(spark):
    from ledgerloom.params import Scenario

    df = spark.createDataFrame([("a", month(0), 3e6)], "series_id string, date date, sales double")
    row = s.apply_scenarios(df, (Scenario("x", -0.2, 0.3, 0.1),)).first()
    assert row["sales"] == pytest.approx(2.4e6)
    assert row["usdtry_rate"] == pytest.approx(39.0)
    with pytest.raises(LedgerError):
        select_scenarios(["base", "nowhere"])


def test_normality_p_values_match_published(spark):
    rows = [("fcf", 1000, -0.1704223732550268, 0.0695860515929998), ("ebit", 1000, 0.10070500170186376, -0.16813762535383825)]
    out = normality_test(spark.createDataFrame(rows, "series_id string, n bigint, skewness double, kurtosis double"))
    p_of = {r["series_id"]: r["normality_p_value"] for r in out.collect()}
    assert p_of["fcf"] == pytest.approx(0.0761610315052825, rel=1e-12)
    assert p_of["ebit"] == pytest.approx(0.23727641778445907, rel=1e-12)


def test_simulation_agrees_with_published_distribution(forecast):
    from ledgerloom.operators import risk as r
    from ledgerloom.params import Risk

    row = r.var_cvar(r.simulate_plans(forecast, Risk(runs=8000))).first()
    assert row["fcf_mean"] == pytest.approx(2.73e6, rel=0.02)
    assert row["fcf_std"] == pytest.approx(1.104e6, rel=0.03)
    assert row["prob_negative_monthly_fcf"] == 1.0
    assert row["fcf_cvar_95"] < row["fcf_var_95"] < row["fcf_mean"]


def test_discounting(forecast):
    plan = p.financial_plan(forecast)
    flows = [r["free_cash_flow"] for r in plan.orderBy("date").collect()]
    want = sum(f * 1.2 ** (-(k + 1) / 12) for k, f in enumerate(flows))
    assert p.discounted_fcf(plan).first()["discounted_fcf"] == pytest.approx(want, rel=1e-12)
    assert p.discounted_fcf(plan, finance=Finance(discount_rate=0.0)).first()["discounted_fcf"] == pytest.approx(sum(flows))
    assert not math.isnan(plan.agg(F.sum("free_cash_flow")).first()[0])
