"""Plans and scenarios: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.q_profile import FIT, sales
from checks.registry import query, view
from checks.sql_parts import POSITION, WS
from ledgerloom.operators import planning as p
from ledgerloom.operators import scenarios as s
from ledgerloom.operators.series import trend_forecast
from ledgerloom.params import FX, OPEX, SALES, STRESS_TESTS
from ledgerloom.plans import pipelines
from ledgerloom.sources.rollup import extract_series

# The money columns of a plan, in their order.
MONEY = (
    "sales", "cogs", "gross_profit", "opex", "ebit", "tax", "nopat", "accounts_receivable", "accounts_payable",
    "inventory", "working_capital", "wc_change", "depreciation", "capex", "free_cash_flow",
)
PLAN = "series_id date:d " + " ".join(f"{c}:2" for c in MONEY) + " usdtry_rate:6"

# Forecasts of the three measures by the trend line, side by side.
for name, column in (("opex", "opex_try"), ("fx", "usdtry")):
    view(f"{name}_series", f"SELECT series_id, date, {column} AS value FROM ledger")
    view(f"{name}_recent", FIT.format(src=f"{name}_series"))
    view(f"{name}_line", f"""
SELECT series_id, max(last_date) AS last_date, regr_slope(value, -back) AS slope, regr_intercept(value, -back) AS icept,
       arg_min(value, back) AS last FROM {name}_recent WHERE back <= 12 GROUP BY 1""")
    view(f"{name}_trend", f"""
SELECT series_id, step, greatest(icept + slope * (step - 1), 0.5 * last) AS forecast
FROM {name}_line CROSS JOIN (SELECT unnest(range(1, 19)) AS step)""")
view("plan_input", "SELECT series_id, date, step, forecast AS sales FROM trend_forecast")
view("plan_input_full", """
SELECT i.*, o.forecast AS opex, f.forecast AS usdtry_rate FROM plan_input i
JOIN opex_trend o ON o.series_id = i.series_id AND o.step = i.step JOIN fx_trend f ON f.series_id = i.series_id AND f.step = i.step""")


def forecast(t):
    return trend_forecast(sales(t)).select("series_id", "date", F.col("forecast").alias("sales"))


def full_forecast(t):
    return pipelines.forecast_measures(t.ledger, 18)


def plan_sql(src, keys="series_id", anchor="usdtry_rate"):
    """The plan of rows that carry sales, opex and usdtry_rate; what is missing must be added before."""
    part = f"PARTITION BY {keys} ORDER BY date"
    whole = f"({part} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    return f"""
SELECT *, nopat + depreciation - capex - wc_change AS free_cash_flow FROM (
 SELECT *, coalesce(working_capital - lag(working_capital) OVER ({part}), 0) AS wc_change,
        50000.0::DOUBLE AS depreciation, 100000.0::DOUBLE AS capex FROM (
  SELECT *, sales * 45 / 30 AS accounts_receivable, cogs * 30 / 30 AS accounts_payable, cogs * 60 / 30 AS inventory,
         sales * 45 / 30 + cogs * 60 / 30 - cogs * 30 / 30 AS working_capital, ebit - greatest(0, ebit * 0.22::DOUBLE) AS nopat,
         greatest(0, ebit * 0.22::DOUBLE) AS tax FROM (
   SELECT *, sales - cogs AS gross_profit, sales - cogs - opex AS ebit FROM (
    SELECT *, sales * 0.65::DOUBLE * (1 + 0.15::DOUBLE * (usdtry_rate / first_value({anchor}) OVER {whole} - 1)) AS cogs FROM {src}))))"""


def default_opex_sql(src, keys="series_id"):
    part = f"(PARTITION BY {keys} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    return f"""SELECT *, first_value(sales) OVER {part} * 0.2::DOUBLE
       * pow(1.05::DOUBLE, row_number() OVER (PARTITION BY {keys} ORDER BY date) - 1) AS opex FROM {src}"""


METRICS_SQL = """
SELECT *, total_free_cash_flow / periods AS avg_monthly_fcf FROM (
 SELECT {keys}, sum(sales) AS total_sales, sum(free_cash_flow) AS total_free_cash_flow, sum(gross_profit) / sum(sales) * 100 AS gross_margin_percent,
       sum(ebit) / sum(sales) * 100 AS ebit_margin_percent, stddev_samp(free_cash_flow) AS fcf_volatility, min(free_cash_flow) AS minimum_fcf,
       arg_max(working_capital, date) / arg_max(sales, date) AS working_capital_intensity, count(*) AS periods
 FROM {src} GROUP BY ALL)"""

query("default_opex", "series_id date:d sales:2 opex:2", lambda t: p.default_opex(forecast(t)), default_opex_sql("plan_input"))
query("default_fx", "series_id date:d sales:2 usdtry_rate:6", lambda t: p.default_fx(forecast(t)),
      "SELECT *, 30.0::DOUBLE AS usdtry_rate FROM plan_input")
view("plan_full", plan_sql("plan_input_full"))
query("cogs_passthrough", "series_id date:d cogs:2", lambda t: p.cogs_passthrough(full_forecast(t)), "SELECT * FROM plan_full")
query("pnl", "series_id date:d gross_profit:2 ebit:2 tax:2 nopat:2", lambda t: p.pnl(p.cogs_passthrough(full_forecast(t))),
      "SELECT * FROM plan_full")
query("working_capital", "series_id date:d accounts_receivable:2 accounts_payable:2 inventory:2 working_capital:2 wc_change:2",
      lambda t: p.working_capital(p.cogs_passthrough(full_forecast(t))), "SELECT * FROM plan_full")
query("free_cash_flow", "series_id date:d depreciation:2 capex:2 free_cash_flow:2",
      lambda t: p.free_cash_flow(p.working_capital(p.pnl(p.cogs_passthrough(full_forecast(t))))), "SELECT * FROM plan_full")
query("financial_plan", PLAN, lambda t: p.financial_plan(forecast(t)), plan_sql("default_fx_opex"))
view("default_fx_opex", default_opex_sql("default_fx"))
query("financial_plan_full", PLAN, lambda t: p.financial_plan(full_forecast(t)), "SELECT * FROM plan_full")
METRICS = ("total_sales:2 total_free_cash_flow:2 gross_margin_percent:6 ebit_margin_percent:6 fcf_volatility:2 minimum_fcf:2 "
           "working_capital_intensity:6")
query("plan_metrics", "series_id " + METRICS, lambda t: p.plan_metrics(p.financial_plan(full_forecast(t))),
      METRICS_SQL.format(keys="series_id", src="plan_full"))
query("discounted_fcf", "series_id discounted_fcf:2", lambda t: p.discounted_fcf(p.financial_plan(full_forecast(t))),
      """SELECT series_id, sum(free_cash_flow * pow(1.2::DOUBLE, -k / 12.0::DOUBLE)) AS discounted_fcf
         FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) AS k FROM plan_full) GROUP BY 1""")

# --- Scenarios -------------------------------------------------------------------------------------

KEYS = "series_id, scenario"


def adjusted_sql(src, has_measures, table="scenario_list"):
    shifted = f"(SELECT i.* REPLACE (i.sales * (1 + c.sales_change) AS sales), c.* FROM {src} i CROSS JOIN {table} c)"
    if has_measures:
        return f"""SELECT * REPLACE (opex * (1 + opex_change) AS opex, usdtry_rate * (1 + fx_change) AS usdtry_rate),
                   usdtry_rate AS base_rate FROM {shifted}"""
    return f"""SELECT * REPLACE (opex * (1 + opex_change) AS opex), 30.0::DOUBLE * (1 + fx_change) AS usdtry_rate,
               30.0::DOUBLE AS base_rate FROM ({default_opex_sql(shifted, KEYS)})"""


view("adjusted", adjusted_sql("plan_input", False))
view("adjusted_full", adjusted_sql("plan_input_full", True))
query("apply_scenarios", "series_id scenario date:d sales:2 opex:2 usdtry_rate:6 base_rate:6",
      lambda t: s.apply_scenarios(full_forecast(t)), "SELECT * FROM adjusted_full")
query("apply_scenarios_defaults", "series_id scenario date:d sales:2 opex:2 usdtry_rate:6",
      lambda t: s.apply_scenarios(forecast(t)), "SELECT * FROM adjusted")
query("run_scenarios", PLAN + " scenario scenario_description", lambda t: s.run_scenarios(forecast(t)), plan_sql("adjusted", KEYS))
query("run_scenarios_full", PLAN + " scenario scenario_description", lambda t: s.run_scenarios(full_forecast(t)),
      plan_sql("adjusted_full", KEYS))
query("run_scenarios_baseline_fx", PLAN + " scenario", lambda t: s.run_scenarios(full_forecast(t), fx_anchor="baseline"),
      plan_sql("adjusted_full", KEYS, "base_rate"))
COMPARED = ("series_id scenario total_sales:2 total_fcf:2 gross_margin_pct:6 ebit_margin_pct:6 min_fcf:2 fcf_volatility:2 "
            "sales_vs_base_pct:6 fcf_vs_base_pct:6")
view("scenario_metrics", METRICS_SQL.format(keys="series_id, scenario, scenario_description", src="run_scenarios_full"))
query("scenario_comparison", COMPARED, lambda t: s.scenario_comparison(s.run_scenarios(full_forecast(t))),
      """SELECT m.series_id, m.scenario, m.total_sales, m.total_free_cash_flow AS total_fcf, m.gross_margin_percent AS gross_margin_pct,
           m.ebit_margin_percent AS ebit_margin_pct, m.minimum_fcf AS min_fcf, m.fcf_volatility,
           (m.total_sales / b.total_sales - 1) * 100 AS sales_vs_base_pct,
           (m.total_free_cash_flow / b.total_free_cash_flow - 1) * 100 AS fcf_vs_base_pct
         FROM scenario_metrics m JOIN scenario_metrics b ON b.series_id = m.series_id AND b.scenario = 'base'""")


def insights(t):
    found = s.scenario_insights(s.scenario_comparison(s.run_scenarios(full_forecast(t))))
    return found.withColumn("negative", F.concat_ws(",", "scenarios_with_negative_fcf"))


query("scenario_insights", "series_id best_case_scenario worst_case_scenario fcf_range:2 risk_percentage:6 risk_level negative", insights,
      """SELECT *, CASE WHEN risk_percentage > 50 THEN 'High' WHEN risk_percentage > 25 THEN 'Medium' ELSE 'Low' END AS risk_level
         FROM (SELECT series_id, arg_max(scenario, total_fcf) AS best_case_scenario, arg_min(scenario, total_fcf) AS worst_case_scenario,
                      max(total_fcf) - min(total_fcf) AS fcf_range,
                      (max(total_fcf) - min(total_fcf)) / max(total_fcf) FILTER (scenario = 'base') * 100 AS risk_percentage,
                      coalesce(string_agg(scenario, ',' ORDER BY scenario) FILTER (min_fcf < 0), '') AS negative
               FROM scenario_comparison GROUP BY 1)""")
query("scenario_summary",
      "series_id scenario_name description total_sales:2 total_free_cash_flow:2 avg_monthly_fcf:2 gross_margin_percent:6 "
      "ebit_margin_percent:6 minimum_monthly_fcf:2 fcf_volatility:2",
      lambda t: s.scenario_summary(s.run_scenarios(full_forecast(t)), "recession"),
      """SELECT *, scenario AS scenario_name, scenario_description AS description, minimum_fcf AS minimum_monthly_fcf
         FROM scenario_metrics WHERE scenario = 'recession'""")
view("stress_list", "SELECT * FROM (VALUES " + ", ".join(
    f"('{x.name}', {x.sales_change}::DOUBLE, {x.fx_change}::DOUBLE, 0.0::DOUBLE)" for x in STRESS_TESTS)
    + ") v(scenario, sales_change, fx_change, opex_change)")
view("stressed", plan_sql("stress_adjusted", KEYS))
view("stress_adjusted", adjusted_sql("plan_input", False, "stress_list"))
query("stress_tests", "series_id scenario total_fcf:2 min_monthly_fcf:2 sales_impact:6 fx_impact:6",
      lambda t: s.stress_tests(forecast(t)),
      """SELECT series_id, scenario, sum(free_cash_flow) AS total_fcf, min(free_cash_flow) AS min_monthly_fcf,
                max(sales_change) AS sales_impact, max(fx_change) AS fx_impact FROM stressed GROUP BY 1, 2""")
