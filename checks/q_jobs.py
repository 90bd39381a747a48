"""Whole jobs: queries and their SQL, which reads the views of the operators that they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.q_ledger import FLAG_CASE, FLAGS, RULES, WHOLE_RANGE
from checks.q_planning import PLAN, forecast
from checks.registry import query, view
from checks.sql_parts import WS
from ledgerloom.operators import scenarios as s
from ledgerloom.params import MEASURES, Settings
from ledgerloom.plans import pipelines
from ledgerloom.plans.lineage import cut, shared_path
from ledgerloom.sources import sinks

BROKEN = "sales_below_min opex_negative fx_negative date_before_min fx_above_max".split()


def counts_sql(src, rules):
    return f"""
SELECT series_id, count(*) AS raw_rows, count(*) - count(date) AS undated_rows, 0 AS malformed_rows, count(date) - count(DISTINCT date) AS repeated_rows,
  count(*) FILTER (date IS NOT NULL AND sales_total_try < {rules.min_sales}) AS sales_below_min, count(*) FILTER (date IS NOT NULL AND opex_try < 0) AS opex_negative,
  count(*) FILTER (date IS NOT NULL AND usdtry < 0) AS fx_negative, count(*) FILTER (date < DATE '{rules.min_date}') AS date_before_min,
  count(*) FILTER (date IS NOT NULL AND usdtry > {rules.max_fx}) AS fx_above_max FROM {src} GROUP BY 1"""


COUNTS = "series_id raw_rows:i undated_rows:i malformed_rows:i repeated_rows:i " + " ".join(f"{b}:i" for b in BROKEN)
query("ingest_counts", COUNTS, lambda t: pipelines.ingest(t.raw_text).counts, counts_sql("raw_typed", Settings().rules))
query("ingest_counts_repeated", COUNTS, lambda t: pipelines.ingest(t.dirty, Settings(rules=RULES), "dup_no").counts, counts_sql("ledger_dirty", RULES))
query("ingest_ledger", "series_id date:d sales_total_try:4 opex_try:4 usdtry:6", lambda t: pipelines.ingest(t.raw_text).ledger, "SELECT * FROM raw_typed WHERE date IS NOT NULL")

# The whole cleaning job, from a dirty ledger to a flagged one with every explanatory column.
view("job_facts", f"""
SELECT *, quantile_cont(sales_total_try, 0.95) OVER {WS} AS p95, quantile_cont(usdtry, 0.5) OVER {WS} AS mid, stddev_samp(usdtry) OVER {WS} AS sd FROM whole_ledger""")
query("clean_job", "series_id date:d sales_total_try:2 opex_try:2 usdtry:6 avg_price_try:4 units_sold:4 cogs_try:2 gross_margin_try:2 promo_intensity:6 competitor_index:6 "
      + " ".join(f"{k}:i" for k in FLAGS) + " data_quality_flag imputation_method",
      lambda t: pipelines.clean_job(t.dirty, Settings(rules=WHOLE_RANGE), "dup_no").ledger,
      f"""SELECT *, {', '.join(f'CAST({p} AS INT) AS {k}' for k, p in FLAGS.items())},
            {FLAG_CASE.format('MISSING', 'OUTLIER', 'OK')} AS data_quality_flag, {FLAG_CASE.format('forward_fill', 'winsorized', 'original')} AS imputation_method
          FROM job_facts JOIN (SELECT series_id, date, avg_price_try, units_sold FROM price_units) USING (series_id, date)
          JOIN (SELECT series_id, date, cogs_try, gross_margin_try FROM cogs_margin) USING (series_id, date)
          JOIN (SELECT series_id, date, promo_intensity FROM promo_intensity) USING (series_id, date)
          JOIN (SELECT series_id, date, competitor_index FROM competitor_index) USING (series_id, date)""")
query("clean_job_report", "series_id row_count:i first_date:d last_date:d " + " ".join(f"{x}_min:2 {x}_max:2 {x}_nulls:i" for x in MEASURES) + " date_nulls:i units_sold_nulls:i",
      lambda t: pipelines.clean_job(t.dirty, Settings(rules=WHOLE_RANGE), "dup_no").report,
      "SELECT series_id, count(*) AS row_count, min(date) AS first_date, max(date) AS last_date, 0 AS date_nulls, 0 AS units_sold_nulls, "
      + ", ".join(f"min({x}) AS {x}_min, max({x}) AS {x}_max, count(*) - count({x}) AS {x}_nulls" for x in MEASURES) + " FROM whole_ledger GROUP BY 1")

# All profiles in one row per series.
SECTIONS = {
    "growth": "growth_stats sales_monthly_mean:6 sales_monthly_std:6 volatility_ratio:6", "trend": "linear_trend sales_trend_slope:4 fx_trend_p_value:6",
    "months": "month_profile peak_month:i trough_month:i", "quarters": "quarter_profile q4_premium:6", "year_end": "year_end_effect year_end_effect:6",
    "annual": "annual_growth average_annual_growth:6 cagr:6", "strength": "detrended_strength seasonal_strength:6",
    "consistency": "growth_consistency positive_growth_ratio:6 trend_direction", "correlation": "correlation_matrix sales_fx:6",
    "volatility": "rolling_volatility sales_max:6 fx_mean:6", "clusters": "volatility_clusters threshold:6 high_volatility_periods:i",
    "persistence": "volatility_persistence volatility_persistence:6", "sensitivity": "sensitivity_labels fx_sensitivity_level", "stationarity": "stationarity lags:i p_value:6",
}
FIGURES = [(section, spec.split()[0], c) for section, spec in SECTIONS.items() for c in spec.split()[1:]]


def profile(t):
    report = pipelines.profile_job(t.ledger).report
    return report.select("series_id", *[F.col(f"{section}.{c.split(':')[0]}") for section, _, c in FIGURES])


query("profile_job", "series_id " + " ".join(c for *_, c in FIGURES), profile,
      "SELECT g.series_id, " + ", ".join(f"any_value({section}.{c.split(':')[0]}) AS {c.split(':')[0]}" for section, _, c in FIGURES)
      + " FROM (SELECT DISTINCT series_id FROM ledger) g" + "".join(f" JOIN {spec.split()[0]} {section} ON {section}.series_id = g.series_id" for section, spec in SECTIONS.items())
      + " GROUP BY 1")

query("risk_job", "series_id overall_risk_level risk_adjusted_return:4 p50:2 normality_p_value:6 worst_stress_fcf:2",
      lambda t: risk(t),
      """SELECT r.series_id, r.overall_risk_level, r.risk_adjusted_return, d.p50, d.normality_p_value, x.worst_stress_fcf FROM risk_summary r
         JOIN distribution_report d ON d.series_id = r.series_id JOIN (SELECT series_id, min(total_fcf) AS worst_stress_fcf FROM stress_tests GROUP BY 1) x ON x.series_id = r.series_id""")


def risk(t):
    study = pipelines.risk_job(forecast(t))
    worst = study.stress.groupBy("series_id").agg(F.min("total_fcf").alias("worst_stress_fcf"))
    return study.summary.join(study.distribution, "series_id").join(worst, "series_id")


# A plan written, one scenario of it written again later, and read back with what its manifest tells.
def written(t):
    plans = cut(s.run_scenarios(forecast(t)))
    path = shared_path(t.spark, "plan")
    sinks.write_plan(plans.where("scenario in ('base', 'stress')").withColumn("sales", F.when(F.col("scenario") == "stress", 0.0).otherwise(F.col("sales"))), path)
    sinks.write_plan(plans.where("scenario in ('stress', 'recession')"), path)
    problems = sinks.plan_problems(t.spark, path, plans.schema).groupBy("scenario").agg(F.count("*").alias("n"))
    return sinks.read_plan(t.spark, path, plans.schema).join(problems, "scenario", "left").withColumn("problems", F.coalesce("n", F.lit(0)))


query("write_plan", PLAN + " scenario problems:i", written,
      "SELECT *, 0 AS problems FROM run_scenarios WHERE scenario IN ('base', 'stress', 'recession')")
