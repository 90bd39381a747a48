"""Monte Carlo risk and chart feeds: queries and their SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks.q_planning import KEYS, MONEY, forecast, full_forecast
from checks.q_profile import sales
from checks.registry import query, view
from checks.sql_parts import WS
from ledgerloom.operators import feeds, planning, risk as r, scenarios as s
from ledgerloom.operators.forecasting import forecast_horizon
from ledgerloom.operators.series import trend_forecast
from ledgerloom.params import SALES, SCENARIOS, Risk
from ledgerloom.plans import pipelines
from ledgerloom.plans.lineage import cut

RISK = Risk()


def uniform(start):
    return f"((('0x' || substr(d, {start}, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)"


def gauss(start):
    return f"(sqrt(-2.0 * ln({uniform(start)})) * cos(2.0 * pi() * {uniform(start + 8)}))"


def draws_view(name, runs):
    view(name, f"""
SELECT series_id, sim_id, period, {gauss(1)} AS z_sales, {gauss(17)} AS z_fx FROM (
  SELECT series_id, sim_id, period, md5(concat_ws('|', '{RISK.seed}', series_id, CAST(sim_id AS VARCHAR), CAST(period AS VARCHAR), 'shock')) AS d
  FROM (SELECT DISTINCT series_id FROM plan_input) CROSS JOIN (SELECT unnest(range(0, {runs})) AS sim_id)
  CROSS JOIN (SELECT unnest(range(1, 19)) AS period))""")


def shocks_sql(src, z, carry, vol):
    """The autoregression in closed form: every earlier draw, discounted by its distance."""
    own = vol * math.sqrt(1 - carry * carry)
    return f"""
SELECT a.series_id, a.sim_id, a.period,
       sum(CASE WHEN b.period = 1 THEN {vol!r}::DOUBLE ELSE {own!r}::DOUBLE END * b.{z} * pow({carry!r}::DOUBLE, a.period - b.period)) AS shock
FROM {src} a JOIN {src} b ON b.series_id = a.series_id AND b.sim_id = a.sim_id AND b.period <= a.period GROUP BY 1, 2, 3"""


draws_view("draws_all", RISK.runs)
view("sales_shock_all", shocks_sql("draws_all", "z_sales", RISK.sales_ar, RISK.sales_vol))
view("fx_shock_all", shocks_sql("draws_all", "z_fx", RISK.fx_ar, RISK.fx_vol))
view("draws_correlated", f"""
SELECT *, {RISK.correlation!r}::DOUBLE * z_sales + {math.sqrt(1 - RISK.correlation ** 2)!r}::DOUBLE * z_fx AS z_both FROM draws_all""")
view("fx_shock_correlated", shocks_sql("draws_correlated", "z_both", RISK.fx_ar, RISK.fx_vol))


def spread(t, risk):
    return r.spread_simulations(r.pack_forecast(full_forecast(t)), risk)


def unfold(df, column, name="shock"):
    return df.select("series_id", "sim_id", F.posexplode_outer(column).alias("k", name)).withColumn("period", F.col("k") + 1)


query("standard_normals", "series_id sim_id:i period:i z_sales:6 z_fx:6",
      lambda t: r.standard_normals(r.pack_forecast(forecast(t)), RISK), "SELECT * FROM draws_all")
query("sales_shocks", "series_id sim_id:i period:i shock:6",
      lambda t: unfold(r.sales_shocks(spread(t, RISK), RISK), "sales_shock"), "SELECT * FROM sales_shock_all")
query("fx_shocks", "series_id sim_id:i period:i shock:6",
      lambda t: unfold(r.fx_shocks(spread(t, RISK), RISK), "fx_shock"), "SELECT * FROM fx_shock_all")
query("correlated_shocks", "series_id sim_id:i period:i shock:6",
      lambda t: unfold(r.fx_shocks(spread(t, RISK), RISK, correlated=True), "fx_shock"), "SELECT * FROM fx_shock_correlated")
query("apply_fx_shocks", "series_id sim_id:i period:i usdtry_rate:6",
      lambda t: unfold(r.apply_fx_shocks(r.fx_shocks(spread(t, RISK), RISK)), "usdtry_rate", "usdtry_rate"),
      """SELECT s.series_id, sim_id, period, usdtry_rate * (1 + shock) AS usdtry_rate FROM fx_shock_all s
         JOIN plan_input_full i ON i.series_id = s.series_id AND i.step = s.period""")


def simulated_sql(plan):
    return f"""
SELECT series_id, sim_id, sum(fcf) AS total_fcf, sum(ebit) AS total_ebit, min(fcf) AS min_monthly_fcf FROM (
  SELECT *, ebit - greatest(0, 0.22::DOUBLE * ebit) + 50000 - 100000
            - coalesce(wc - lag(wc) OVER (PARTITION BY series_id, sim_id ORDER BY period), 0) AS fcf
  FROM (SELECT *, s - cogs - opex AS ebit, s * 45 / 30 + cogs * 60 / 30 - cogs * 30 / 30 AS wc FROM ({plan}))) GROUP BY 1, 2"""


FIRST = "(PARTITION BY series_id, sim_id ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
view("shocked_all", """
SELECT k.series_id, sim_id, period, sales * (1 + shock) AS s FROM sales_shock_all k
JOIN plan_input i ON i.series_id = k.series_id AND i.step = k.period""")
view("sims", simulated_sql(f"""
SELECT *, s * 0.65::DOUBLE AS cogs, first_value(s) OVER {FIRST} * 0.2::DOUBLE * pow(1.05::DOUBLE, period - 1) AS opex FROM shocked_all"""))


def full_sim_sql(fx, anchor):
    return simulated_sql(f"""
SELECT *, s * 0.65::DOUBLE * (1 + 0.15::DOUBLE * (rate / first_value({anchor}) OVER {FIRST} - 1)) AS cogs FROM (
  SELECT k.series_id, k.sim_id, k.period, sales * (1 + k.shock) AS s, opex, usdtry_rate * (1 + x.shock) AS rate, usdtry_rate AS base_rate
  FROM sales_shock_all k JOIN {fx} x ON x.series_id = k.series_id AND x.sim_id = k.sim_id AND x.period = k.period
  JOIN plan_input_full i ON i.series_id = k.series_id AND i.step = k.period)""")


SIMS = "series_id sim_id:i total_fcf:1 total_ebit:1 min_monthly_fcf:1"


def sims(t):
    return r.simulate_plans(forecast(t), RISK)


def kept(t):
    """The same, computed once for queries that read it more than once."""
    return cut(sims(t))


query("simulate_plans", SIMS, sims, "SELECT * FROM sims")
query("simulate_plans_full", SIMS, lambda t: r.simulate_plans(full_forecast(t), RISK), full_sim_sql("fx_shock_all", "rate"))
query("simulate_plans_correlated", SIMS,
      lambda t: r.simulate_plans(full_forecast(t), RISK, correlated=True, fx_anchor="baseline"),
      full_sim_sql("fx_shock_correlated", "base_rate"))
LOSS = """avg(CAST(min_monthly_fcf < 0 AS DOUBLE)) AS prob_negative_monthly_fcf, avg(CAST(total_fcf < 0 AS DOUBLE)) AS prob_negative_total_fcf"""


def var_sql(src):
    return f"""
SELECT *, fcf_std / fcf_mean AS fcf_coefficient_of_variation FROM (
  SELECT series_id, max(fv) AS fcf_var_95, avg(total_fcf) FILTER (total_fcf <= fv) AS fcf_cvar_95, max(ev) AS ebit_var_95,
         avg(total_ebit) FILTER (total_ebit <= ev) AS ebit_cvar_95, avg(total_fcf) AS fcf_mean, stddev_pop(total_fcf) AS fcf_std,
         min(total_fcf) AS fcf_min, max(total_fcf) AS fcf_max, {LOSS}
  FROM (SELECT *, quantile_cont(total_fcf, 0.05) OVER {WS} AS fv, quantile_cont(total_ebit, 0.05) OVER {WS} AS ev FROM {src}) GROUP BY 1)"""


VAR = ("series_id fcf_var_95:2 fcf_cvar_95:2 ebit_var_95:2 ebit_cvar_95:2 fcf_mean:2 fcf_std:2 fcf_min:2 fcf_max:2 "
       "prob_negative_monthly_fcf:6 prob_negative_total_fcf:6 fcf_coefficient_of_variation:6")
query("var_cvar", VAR, lambda t: r.var_cvar(kept(t)), var_sql("sims"))
query("loss_probability", "series_id prob_negative_monthly_fcf:6 prob_negative_total_fcf:6", lambda t: r.loss_probability(sims(t)),
      f"SELECT series_id, {LOSS} FROM sims GROUP BY 1")
POINTS = [f"p{p}" for p in r.PERCENTILES]
query("distribution_percentiles", "series_id " + " ".join(f"{p}:2" for p in POINTS), lambda t: r.distribution_percentiles(kept(t)),
      "SELECT series_id, " + ", ".join(f"quantile_cont(total_fcf, {p / 100}) AS p{p}" for p in r.PERCENTILES) + " FROM sims GROUP BY 1")
view("moments", """
SELECT series_id, count(*) AS n, max(mu) AS mean, stddev_pop(v) AS std, avg((v - mu) ** 3) / stddev_pop(v) ** 3 AS skewness,
       avg((v - mu) ** 4) / stddev_pop(v) ** 4 - 3 AS kurtosis
FROM (SELECT series_id, total_fcf AS v, avg(total_fcf) OVER (PARTITION BY series_id) AS mu FROM sims) GROUP BY 1""")
query("distribution_moments", "series_id n:i mean:2 std:2 skewness:6 kurtosis:6", lambda t: r.distribution_moments(sims(t)),
      "SELECT * FROM moments")
view("omnibus", """
SELECT *, d * asinh(y / a) AS z1, (1 - 2 / (9 * big) - sign(dd) * cbrt((1 - 2 / big) / abs(dd))) / sqrt(2 / (9 * big)) AS z2 FROM (
 SELECT *, 1 + x * sqrt(2 / (big - 4)) AS dd FROM (
  SELECT *, 1 / sqrt(0.5 * ln(w2)) AS d, sqrt(2 / (w2 - 1)) AS a, 6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) AS big FROM (
   SELECT *, sqrt(2 * (b - 1)) - 1 AS w2 FROM (
    SELECT series_id, n, mean, std, skewness, kurtosis,
      skewness * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
      3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b,
      (kurtosis + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS s
    FROM (SELECT * REPLACE (CAST(n AS DOUBLE) AS n) FROM moments)))))""")
TESTED = "SELECT *, z1 * z1 + z2 * z2 AS k2, exp(-(z1 * z1 + z2 * z2) / 2) AS normality_p_value, exp(-(z1 * z1 + z2 * z2) / 2) > 0.05 AS is_normal FROM omnibus"
query("normality_test", "series_id n:i skewness:6 kurtosis:6 k2:4 normality_p_value:6 is_normal:b",
      lambda t: r.normality_test(r.distribution_moments(sims(t))), TESTED)
query("distribution_report", "series_id " + " ".join(f"{p}:2" for p in POINTS) + " mean:2 std:2 normality_p_value:6 is_normal:b",
      lambda t: r.distribution_report(kept(t)),
      f"SELECT * FROM distribution_percentiles JOIN ({TESTED}) USING (series_id)")
query("risk_summary",
      "series_id overall_risk_level expected_total_fcf:2 worst_case_5pct:2 expected_shortfall:2 probability_of_loss:6 volatility:2 risk_adjusted_return:6",
      lambda t: r.risk_summary(r.var_cvar(kept(t))),
      """SELECT series_id, fcf_mean AS expected_total_fcf, fcf_var_95 AS worst_case_5pct, fcf_cvar_95 AS expected_shortfall,
           prob_negative_total_fcf AS probability_of_loss, fcf_std AS volatility, fcf_mean / fcf_std AS risk_adjusted_return,
           CASE WHEN fcf_coefficient_of_variation > 0.5 OR prob_negative_total_fcf > 0.2 THEN 'High'
                WHEN fcf_coefficient_of_variation > 0.3 OR prob_negative_total_fcf > 0.1 THEN 'Medium' ELSE 'Low' END AS overall_risk_level
         FROM var_cvar""")
view("tails", f"""
SELECT series_id, sim_id, min_monthly_fcf,
       greatest(least(total_fcf, quantile_cont(total_fcf, 0.995) OVER {WS}), quantile_cont(total_fcf, 0.005) OVER {WS}) AS total_fcf,
       greatest(least(total_ebit, quantile_cont(total_ebit, 0.995) OVER {WS}), quantile_cont(total_ebit, 0.005) OVER {WS}) AS total_ebit FROM sims""")
query("winsorize_tails", VAR, lambda t: r.var_cvar(r.winsorize_tails(kept(t))), var_sql("tails"))

# --- Feeds -----------------------------------------------------------------------------------------

query("forecast_feed", "series_id date:d kind value:4 lower_bound:2 upper_bound:2",
      lambda t: feeds.forecast_feed(sales(t), forecast_horizon(sales(t))),
      """SELECT series_id, date, 'history' AS kind, value, NULL::DOUBLE AS lower_bound, NULL::DOUBLE AS upper_bound FROM sales_series
         UNION ALL SELECT series_id, date, 'forecast', forecast, lower_bound, upper_bound FROM forecast_horizon""")
NAMES = [x.name for x in SCENARIOS]
query("scenario_feed", "series_id date:d " + " ".join(f"{n}:2" for n in NAMES),
      lambda t: feeds.scenario_feed(s.run_scenarios(full_forecast(t))),
      "SELECT series_id, date, " + ", ".join(f"sum(free_cash_flow) FILTER (scenario = '{n}') AS {n}" for n in NAMES)
      + " FROM run_scenarios_full GROUP BY 1, 2")
view("sim_ends", f"SELECT *, min(total_fcf) OVER {WS} AS lo, max(total_fcf) OVER {WS} AS hi, count(*) OVER {WS} AS n FROM sims")
query("risk_histogram", "series_id bin:i bin_start:2 bin_end:2 count:i density:6", lambda t: feeds.risk_histogram(kept(t))
      .withColumn("density", F.col("density") * 1e6),
      """SELECT series_id, bin, lo + bin * (hi - lo) / 50 AS bin_start, lo + (bin + 1) * (hi - lo) / 50 AS bin_end, c AS count,
                c / (n * (hi - lo) / 50) * 1e6 AS density
         FROM (SELECT series_id, b AS bin, max(lo) AS lo, max(hi) AS hi, max(n) AS n,
                      count(*) FILTER (least(CAST(floor((total_fcf - lo) / ((hi - lo) / 50)) AS INT), 49) = b) AS c
               FROM sim_ends CROSS JOIN (SELECT unnest(range(50)) AS b) GROUP BY 1, 2)""")


def box_sql(src, col, keys):
    return f"""
SELECT {keys}, min(v) FILTER (v >= a - 1.5 * (c - a)) AS whisker_low, max(a) AS q1, max(b) AS median, max(c) AS q3,
       max(v) FILTER (v <= c + 1.5 * (c - a)) AS whisker_high,
       count(*) FILTER (v < a - 1.5 * (c - a) OR v > c + 1.5 * (c - a)) AS outliers
FROM (SELECT {keys}, {col} AS v, quantile_cont({col}, 0.25) OVER w AS a, quantile_cont({col}, 0.5) OVER w AS b,
             quantile_cont({col}, 0.75) OVER w AS c FROM {src} WINDOW w AS (PARTITION BY {keys})) GROUP BY ALL"""


BOX = "whisker_low:2 q1:2 median:2 q3:2 whisker_high:2 outliers:i"
query("box_stats", "series_id " + BOX, lambda t: feeds.box_stats(kept(t), "total_fcf"), box_sql("sims", "total_fcf", "series_id"))
query("box_stats_by_quarter", "series_id quarter:i " + BOX.replace(":2", ":4"),
      lambda t: feeds.box_stats(t.ledger.withColumn("quarter", F.quarter("date")), SALES, ("series_id", "quarter")),
      box_sql("(SELECT *, quarter(date) AS quarter FROM ledger)", "sales_total_try", "series_id, quarter"))
query("dashboard_feed", "series_id date:d sales:2 gross_profit:2 ebit:2 ebit_margin_pct:6 free_cash_flow:2 fcf_sign working_capital:2",
      lambda t: feeds.dashboard_feed(planning.financial_plan(full_forecast(t))),
      """SELECT *, ebit / CASE WHEN sales = 0 THEN 1 ELSE sales END * 100 AS ebit_margin_pct,
                CASE WHEN free_cash_flow >= 0 THEN 'positive' ELSE 'negative' END AS fcf_sign FROM plan_full""")
view("plan_default_metrics", """
SELECT series_id, sum(sales) AS total_sales, sum(free_cash_flow) AS total_free_cash_flow, sum(gross_profit) / sum(sales) * 100 AS gross_margin_percent,
       sum(ebit) / sum(sales) * 100 AS ebit_margin_percent, min(free_cash_flow) AS minimum_fcf FROM financial_plan GROUP BY 1""")
view("default_totals", "SELECT series_id, scenario, sum(free_cash_flow) AS total FROM run_scenarios GROUP BY 1, 2")
view("default_insights", """
SELECT series_id, arg_max(scenario, total) AS best_case_scenario, arg_min(scenario, total) AS worst_case_scenario, max(total) - min(total) AS fcf_range,
       CASE WHEN (max(total) - min(total)) / max(total) FILTER (scenario = 'base') > 0.5 THEN 'High'
            WHEN (max(total) - min(total)) / max(total) FILTER (scenario = 'base') > 0.25 THEN 'Medium' ELSE 'Low' END AS scenario_risk_level
FROM default_totals GROUP BY 1""")
query("executive_kpis",
      "series_id total_sales:2 total_free_cash_flow:2 gross_margin_percent:6 ebit_margin_percent:6 minimum_fcf:2 overall_risk_level "
      "worst_case_5pct:2 expected_shortfall:2 probability_of_loss:6 volatility:2 best_case_scenario worst_case_scenario fcf_range:2 scenario_risk_level",
      lambda t: pipelines.plan_from_forecast(forecast(t)).kpis,
      """SELECT * FROM plan_default_metrics JOIN risk_summary USING (series_id) JOIN default_insights USING (series_id)""")
