"""Sources, validation, cleaning and features: queries and their SQL."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.inputs import K, RULES, WHOLE_RANGE
from checks.registry import query, view
from checks.sql_parts import DAYS, MEASURES, POSITION, W, WALL, WS, clip, fill, interpolate, near, normal, smooth
from ledgerloom.operators import cleaning as c
from ledgerloom.operators import features as f
from ledgerloom.operators import quality as q
from ledgerloom.params import FX, OPEX, RANDOM_SEED, SALES, SCENARIOS
from ledgerloom.sources import readers, rollup, scenarios, sinks

LEDGER = "series_id date:d sales_total_try:4 opex_try:4 usdtry:6"
CLEANED = "series_id date:d sales_total_try:2 opex_try:2 usdtry:6"


def one_per_date(t):
    return rollup.dedup_first(t.dirty, "dup_no").drop("dup_no")


def prepared(t):
    return c.prepare_ledger(one_per_date(t))


# --- Sources ---------------------------------------------------------------------------------------

FORMATS = (
    "['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%Y/%m/%d', '%Y%m%d', '%m/%d/%Y', '%d/%m/%Y']"
)
view("raw_typed", f"""
SELECT series_id, CAST(try_strptime("Timestamp", {FORMATS}) AS DATE) AS date,
       TRY_CAST("Sales" AS DOUBLE) AS sales_total_try, TRY_CAST("Operating_Expenses" AS DOUBLE) AS opex_try,
       TRY_CAST("FX_rate" AS DOUBLE) AS usdtry FROM raw_text""")
query("read_ledger", LEDGER, lambda t: readers.standardize_schema(t.raw_text),
      "SELECT * FROM raw_typed WHERE date IS NOT NULL")
FIELDS = ["series_id", "Timestamp", "Sales", "Operating_Expenses", "FX_rate"]
query("read_ledger_lines", LEDGER,
      lambda t: readers.ledger_from_lines(t.raw_text.select(F.to_csv(F.struct(*FIELDS)).alias("line")), FIELDS),
      "SELECT * FROM raw_typed WHERE date IS NOT NULL")
query("read_ledger_dropped", "series_id raw_rows:i undated_rows:i", lambda t: readers.undated_rows(t.raw_text),
      "SELECT series_id, count(*) AS raw_rows, count(*) - count(date) AS undated_rows FROM raw_typed GROUP BY 1")
query("standardize_schema", LEDGER,
      lambda t: readers.standardize_schema(t.raw_text.withColumnRenamed("Sales", "SALES_TRY"), drop_undated=False),
      "SELECT * FROM raw_typed")
query("monthly_ledger", LEDGER, lambda t: t.ledger_nation, "SELECT * FROM ledger_nation")
query("extract_series", "series_id date:d value:6", lambda t: rollup.extract_series(t.ledger, FX),
      "SELECT series_id, date, usdtry AS value FROM ledger")

SCENARIO_VALUES = ", ".join(
    f"('{s.name}', {s.sales_change}::DOUBLE, {s.fx_change}::DOUBLE, {s.opex_change}::DOUBLE, '{s.description}')"
    for s in SCENARIOS
)
view("scenario_list", f"""
SELECT * FROM (VALUES {SCENARIO_VALUES}) v(scenario, sales_change, fx_change, opex_change, scenario_description)""")
# The table alone would not read the data: it is shown beside the sales each scenario starts from.
query("scenario_table", "series_id scenario sales_change:6 fx_change:6 opex_change:6 scenario_description first_sales:2",
      lambda t: t.ledger.groupBy("series_id").agg(F.min_by(SALES, "date").alias("sales"))
      .select("series_id", "sales", F.inline(scenarios.scenario_array(SCENARIOS)))
      .withColumn("first_sales", F.col("sales") * (1 + F.col("sales_change"))),
      """SELECT series_id, s.*, sales * (1 + sales_change) AS first_sales
         FROM (SELECT series_id, arg_min(sales_total_try, date) AS sales FROM ledger GROUP BY 1) CROSS JOIN scenario_list s""")

# --- Validation ------------------------------------------------------------------------------------

BROKEN = {
    "sales_below_min": "sales_total_try < 0",
    "opex_negative": "opex_try < 0",
    "fx_negative": "usdtry < 0",
    "date_before_min": f"date < DATE '{RULES.min_date}'",
    "fx_above_max": "usdtry > 60.0",
}
query("rule_violations", "series_id " + " ".join(f"{k}:i" for k in BROKEN),
      lambda t: q.rule_violations(t.dirty, RULES),
      "SELECT series_id, " + ", ".join(f"count(*) FILTER ({p}) AS {k}" for k, p in BROKEN.items())
      + " FROM ledger_dirty GROUP BY 1")
query("quarantine", LEDGER + " broken_rules",
      lambda t: q.quarantine(t.dirty, RULES).withColumn("broken_rules", F.concat_ws(",", "broken_rules")),
      "SELECT * FROM (SELECT *, concat_ws(',', "
      + ", ".join(f"CASE WHEN {p} THEN '{k}' END" for k, p in BROKEN.items())
      + ") AS broken_rules FROM ledger_dirty) WHERE broken_rules <> ''")
query("null_counts", "series_id column_name null_count:i", lambda t: q.null_counts(t.dirty),
      " UNION ALL ".join(
          f"SELECT series_id, '{x}' AS column_name, count(*) - count({x}) AS null_count FROM ledger_dirty GROUP BY 1"
          for x in ("date", *MEASURES, "dup_no")))
query("date_gaps", "series_id large_gaps:i", lambda t: q.date_gaps(t.dirty),
      f"""SELECT series_id, count(*) FILTER (gap > 45) AS large_gaps
          FROM (SELECT series_id, date - lag(date) OVER {W} AS gap
                FROM (SELECT DISTINCT series_id, date FROM ledger_dirty)) GROUP BY 1""")
query("dedup_first", LEDGER + " dup_no:i", lambda t: rollup.dedup_first(t.dirty, "dup_no"),
      """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY series_id, date ORDER BY dup_no) AS rn
         FROM ledger_dirty) WHERE rn = 1""")


def incomplete(t):
    """Doubled rows of which one lacks sales, and first copies without their number."""
    k = (F.year("date") - 1995) * 12 + F.month("date") - 1
    lost = (F.col("dup_no") == 0) & (k % 31 == 10) & (F.col("series_id") < "F")
    return t.dirty.withColumns({SALES: F.when(~lost, F.col(SALES)), "copy": F.when(F.col("dup_no") > 0, F.col("dup_no"))}).drop("dup_no")


view("incomplete", f"""
SELECT * EXCLUDE (dup_no, k) REPLACE (CASE WHEN dup_no = 0 AND k % 31 = 10 AND series_id < 'F' THEN NULL ELSE sales_total_try END AS sales_total_try),
       CASE WHEN dup_no > 0 THEN dup_no END AS copy FROM (SELECT *, {K} AS k FROM ledger_dirty)""")
NULLS = " + ".join(f"(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END)" for x in MEASURES)
query("dedup_first_incomplete", LEDGER + " way copy:i",
      lambda t: rollup.dedup_first(incomplete(t), "copy").withColumn("way", F.lit("by copy")).unionByName(
          rollup.dedup_first(incomplete(t).drop("copy")).withColumns({"way": F.lit("complete"), "copy": F.lit(None).cast("int")})),
      f"""SELECT * FROM (SELECT DISTINCT ON (series_id, date) *, 'by copy' AS way FROM incomplete ORDER BY series_id, date, copy NULLS LAST)
          UNION ALL BY NAME
          SELECT * FROM (SELECT DISTINCT ON (series_id, date) * EXCLUDE (copy), 'complete' AS way, NULL AS copy FROM incomplete
          ORDER BY series_id, date, {NULLS}, sales_total_try NULLS FIRST, opex_try, usdtry NULLS FIRST)""")
query("ledger_total", "series_id lines:i sales_total_try:2 opex_try:2",
      lambda t: t.ledger.groupBy("series_id").agg(F.sum(SALES).alias(SALES), F.sum(OPEX).alias(OPEX)).join(
          t.lines.groupBy("series_id").agg(F.count("*").alias("lines")), "series_id"),
      """SELECT c_mktsegment AS series_id, count(*) AS lines, sum(l_extendedprice * (1 - l_discount)) AS sales_total_try,
             sum(l_extendedprice * (0.20 + l_tax)) AS opex_try
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
query("trim_dates", LEDGER, lambda t: q.trim_dates(t.ledger, "1996-02-01", "2000-09-01"),
      "SELECT * FROM ledger WHERE date BETWEEN DATE '1996-02-01' AND DATE '2000-09-01'")


def tagged(train, test):
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


query("split_last_n", "series_id date:d sales_total_try:4 part", lambda t: tagged(*q.split_last_n(t.ledger, 6)),
      """SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 6
                        THEN 'test' ELSE 'train' END AS part FROM ledger""")
query("split_by_date", "series_id date:d sales_total_try:4 part",
      lambda t: tagged(*q.split_by_date(t.ledger, "2000-06-01")),
      "SELECT *, CASE WHEN date < DATE '2000-06-01' THEN 'train' ELSE 'test' END AS part FROM ledger")
view("flag_facts", f"""
SELECT *, quantile_cont(sales_total_try, 0.95) OVER {WS} AS p95, quantile_cont(usdtry, 0.5) OVER {WS} AS mid,
       stddev_samp(usdtry) OVER {WS} AS sd FROM dedup_first""")
FLAG_CASE = """CASE WHEN sales_total_try IS NULL OR opex_try IS NULL OR usdtry IS NULL THEN '{0}'
                WHEN sales_total_try > p95 OR abs(usdtry - mid) > 2 * sd THEN '{1}' ELSE '{2}' END"""
query("quality_flags", LEDGER + " data_quality_flag imputation_method", lambda t: q.quality_flags(one_per_date(t)),
      f"""SELECT *, {FLAG_CASE.format('MISSING', 'OUTLIER', 'OK')} AS data_quality_flag,
                 {FLAG_CASE.format('forward_fill', 'winsorized', 'original')} AS imputation_method FROM flag_facts""")
view("quartiles", f"""
SELECT *, quantile_cont(sales_total_try, 0.25) OVER {WS} AS s1, quantile_cont(sales_total_try, 0.75) OVER {WS} AS s3,
       quantile_cont(usdtry, 0.25) OVER {WS} AS f1, quantile_cont(usdtry, 0.75) OVER {WS} AS f3 FROM dedup_first""")
query("iqr_outliers", "series_id sales_outliers:i fx_outliers:i", lambda t: q.iqr_outliers(one_per_date(t)),
      """SELECT series_id,
           count(*) FILTER (sales_total_try < s1 - 1.5 * (s3 - s1) OR sales_total_try > s3 + 1.5 * (s3 - s1)) AS sales_outliers,
           count(*) FILTER (usdtry < f1 - 1.5 * (f3 - f1) OR usdtry > f3 + 1.5 * (f3 - f1)) AS fx_outliers
         FROM quartiles GROUP BY 1""")
COMPLETE = [f"{x}_complete_pct" for x in ("date", *MEASURES, "dup_no")]
query("quality_assessment",
      "series_id " + " ".join(f"{x}:6" for x in COMPLETE)
      + " monotonic_dates:b positive_sales:b reasonable_fx:b overall_quality",
      lambda t: q.quality_assessment(t.dirty),
      f"""SELECT *, CASE WHEN monotonic_dates AND positive_sales AND reasonable_fx AND least({', '.join(COMPLETE)}) > 95
                    THEN 'Good' ELSE 'Needs Review' END AS overall_quality
          FROM (SELECT series_id, {', '.join(f'count({x[:-13]}) / count(*) * 100 AS {x}' for x in COMPLETE)},
                       bool_and(date IS NOT NULL) AS monotonic_dates,
                       bool_and(coalesce(sales_total_try >= 0, false)) AS positive_sales,
                       bool_and(coalesce(usdtry > 0 AND usdtry < 100, false)) AS reasonable_fx
                FROM ledger_dirty GROUP BY 1)""")
query("ledger_summary",
      "series_id total_records:i first_date:d last_date:d sales_mean:2 sales_median:4 sales_std:2 sales_min:4 "
      "sales_max:4 fx_mean:6 fx_median:6 fx_min:6 fx_max:6",
      lambda t: q.ledger_summary(prepared(t)),
      """SELECT series_id, count(*) AS total_records, min(date) AS first_date, max(date) AS last_date,
           avg(sales_total_try) AS sales_mean, quantile_cont(sales_total_try, 0.5) AS sales_median,
           stddev_samp(sales_total_try) AS sales_std, min(sales_total_try) AS sales_min, max(sales_total_try) AS sales_max,
           avg(usdtry) AS fx_mean, quantile_cont(usdtry, 0.5) AS fx_median, min(usdtry) AS fx_min, max(usdtry) AS fx_max
         FROM prepare_ledger GROUP BY 1""")
query("nest_report", "series_id total_records:i sales_mean:2 sales_outliers:i fx_outliers:i",
      lambda t: sinks.nest_report({"summary": q.ledger_summary(prepared(t)), "outliers": q.iqr_outliers(one_per_date(t))}).select(
          "series_id", "summary.total_records", "summary.sales_mean", "outliers.sales_outliers", "outliers.fx_outliers"),
      "SELECT * FROM ledger_summary JOIN iqr_outliers USING (series_id)")
query("describe_measures", "series_id measure count:i mean:2 std:2 min:4 p25:4 p50:4 p75:4 max:4",
      lambda t: q.describe(one_per_date(t)),
      " UNION ALL ".join(
          f"""SELECT series_id, '{x}' AS measure, count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std,
              min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50,
              quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM dedup_first GROUP BY 1""" for x in MEASURES))
INTEGRITY = "SELECT series_id, count(*) AS row_count, min(date) AS first_date, max(date) AS last_date, " + ", ".join(
    [f"min({x}) AS {x}_min, max({x}) AS {x}_max" for x in MEASURES]
    + [f"count(*) - count({x}) AS {x}_nulls" for x in ("date", *MEASURES)])
query("integrity_report",
      "series_id row_count:i first_date:d last_date:d "
      + " ".join(f"{x}_min:4 {x}_max:4 {x}_nulls:i" for x in MEASURES) + " date_nulls:i",
      lambda t: q.integrity_report(t.dirty), INTEGRITY + " FROM ledger_dirty GROUP BY 1")

# --- Cleaning --------------------------------------------------------------------------------------

query("fill_forward_back", LEDGER, lambda t: c.fill_forward_back(one_per_date(t), [SALES, OPEX, FX]),
      fill("dedup_first", MEASURES))
query("interpolate_linear", CLEANED, lambda t: c.interpolate_linear(one_per_date(t), SALES),
      interpolate("dedup_first", "sales_total_try", POSITION, both_ends=True))
query("interpolate_time", CLEANED, lambda t: c.interpolate_time(one_per_date(t), FX),
      interpolate("dedup_first", "usdtry", DAYS))
# Daily values by user have missing days; the days themselves are the axis.
view("daily_gappy", """
SELECT series_id, date, CASE WHEN day(date) % 5 = 3 THEN NULL ELSE value END AS value FROM events_daily""")
query("interpolate_time_daily", "series_id date:d value:4",
      lambda t: c.interpolate_time(
          t.daily.withColumn("value", F.when(F.dayofmonth("date") % 5 != 3, F.col("value"))), "value"),
      interpolate("daily_gappy", "value", DAYS))


def seasonal_sql(src):
    by_month = interpolate(
        f"(SELECT *, sales_total_try AS raw, month(date) AS mo, count(sales_total_try) OVER {WS} AS known FROM {src})",
        "sales_total_try", DAYS, "series_id, mo")
    chosen = f"(SELECT * EXCLUDE (raw, mo, known) REPLACE (CASE WHEN known < 12 THEN raw ELSE sales_total_try END AS sales_total_try) FROM ({by_month}))"
    return interpolate(chosen, "sales_total_try", DAYS)


query("interpolate_seasonal", CLEANED, lambda t: c.interpolate_seasonal(one_per_date(t), SALES),
      seasonal_sql("dedup_first"))
view("laddered", f"""
SELECT s.* REPLACE (coalesce(s.sales_total_try, CASE WHEN m.med > 0 THEN m.med END, 2500000.0) AS sales_total_try)
FROM ({interpolate('dedup_first', 'sales_total_try', POSITION, both_ends=True)}) s
JOIN (SELECT series_id, quantile_cont(sales_total_try, 0.5) AS med FROM dedup_first GROUP BY 1) m USING (series_id)""")
query("impute_ladder", CLEANED, lambda t: c.impute_ladder(one_per_date(t)), "SELECT * FROM laddered")
query("prepare_ledger", CLEANED, prepared, fill("laddered", ("opex_try", "usdtry")))
query("clip_fx", LEDGER, lambda t: c.clip_fx(one_per_date(t)),
      f"SELECT * REPLACE ({clip('usdtry', '3.5', '60.0')} AS usdtry) FROM dedup_first")


def winsor_sql(src, col, low, high):
    bounds = f"SELECT *, quantile_cont({col}, {low}) OVER {WS} AS lo, quantile_cont({col}, {high}) OVER {WS} AS hi FROM {src}"
    return f"SELECT * EXCLUDE (lo, hi) REPLACE ({clip(col, 'lo', 'hi')} AS {col}) FROM ({bounds})"


def winsor_ledger_sql(src):
    return (f"SELECT * REPLACE (abs(sales_total_try) AS sales_total_try, abs(opex_try) AS opex_try, abs(usdtry) AS usdtry) "
            f"FROM ({winsor_sql(src, 'sales_total_try', 0.01, 0.99)})")


query("winsorize", CLEANED, lambda t: c.winsorize_ledger(one_per_date(t)), winsor_ledger_sql("dedup_first"))
query("smooth_median_mean", CLEANED, lambda t: c.smooth_median_mean(one_per_date(t), SALES),
      smooth("dedup_first", "sales_total_try"))


def opex_sql(src):
    share = clip("opex_try / sales_total_try", "0.05", "1.0")
    shared = f"(SELECT *, CASE WHEN sales_total_try > 0 AND opex_try >= 0 THEN {share} END AS share FROM {src})"
    based = f"(SELECT *, {clip(f'coalesce(quantile_cont(share, 0.5) OVER {WS}, 0.30)', '0.25', '0.35')} AS base FROM ({smooth(shared, 'share')}))"
    season = "((1.0 + 0.025 * sin(2 * pi() * (month(date) - 1) / 12)) * (CASE WHEN month(date) >= 10 THEN 1.015 ELSE 1.0 END))"
    bounded = clip(f"{clip('coalesce(share, base)', '0.20', '0.40')} * {season}", "0.20", "0.40")
    return f"SELECT * EXCLUDE (share, base) REPLACE ({bounded} * sales_total_try AS opex_try) FROM {based}"


query("recompute_opex", CLEANED, lambda t: c.recompute_opex(one_per_date(t)), opex_sql("dedup_first"))


def spine_sql(src):
    return f"""
SELECT s.series_id, s.date, l.* EXCLUDE (series_id, date)
FROM (SELECT series_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS DATE) AS date
      FROM {src} GROUP BY 1) s
LEFT JOIN {src} l ON l.series_id = s.series_id AND l.date = s.date"""


def by_month_sql(src):
    return f"""
SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS date, sum(sales_total_try) AS sales_total_try,
       sum(opex_try) AS opex_try, avg(usdtry) AS usdtry FROM {src} GROUP BY 1, 2"""


def any_day(t):
    """Rows dated anywhere in their month, doubled ones two days later."""
    days = F.dayofyear("date") % 19 + 2 * F.col("dup_no")
    return t.dirty.withColumn("date", F.date_add("date", days.cast("int"))).drop("dup_no")


def at_month_end(t):
    return t.dirty.withColumn("date", F.last_day("date"))


query("reindex_calendar", LEDGER, lambda t: c.reindex_calendar(one_per_date(t)), spine_sql("dedup_first"))
view("any_day", "SELECT * EXCLUDE (dup_no) REPLACE (date + CAST(dayofyear(date) % 19 + 2 * dup_no AS INT) AS date) FROM ledger_dirty")
view("any_day_months", by_month_sql("any_day"))
query("reindex_calendar_any_day", CLEANED, lambda t: c.reindex_calendar(any_day(t)), spine_sql("any_day_months"))


def clean_views(prefix, source):
    """Views named with the prefix: the repair of `source`, one row per month, step by step. The last is `<prefix>_9`."""
    view(f"{prefix}_2", spine_sql(source))
    view(f"{prefix}_3", f"SELECT * REPLACE ({clip('usdtry', '3.5', '60.0')} AS usdtry) FROM {prefix}_2")
    view(f"{prefix}_4", winsor_ledger_sql(f"{prefix}_3"))
    view(f"{prefix}_5", seasonal_sql(f"{prefix}_4"))
    view(f"{prefix}_6", smooth(f"{prefix}_5", "sales_total_try"))
    view(f"{prefix}_7", interpolate(f"{prefix}_6", "usdtry", DAYS))
    view(f"{prefix}_8", fill(f"{prefix}_7", ["usdtry"]))
    view(f"{prefix}_9", f"SELECT * REPLACE ({clip('usdtry', '3.5', '60.0')} AS usdtry) FROM {prefix}_8")


BOUNDS = f"date BETWEEN DATE '{RULES.first_date}' AND DATE '{RULES.last_date}'"
view("clean_1", f"SELECT * EXCLUDE (dup_no) FROM dedup_first WHERE {BOUNDS}")
clean_views("clean", "clean_1")
query("clean_ledger", CLEANED, lambda t: c.clean_ledger(t.dirty, RULES, "dup_no"), opex_sql("clean_9"))
view("ended_1", f"SELECT * EXCLUDE (dup_no) REPLACE (date_trunc('month', date)::DATE AS date) FROM (SELECT * REPLACE (last_day(date) AS date) FROM dedup_first) WHERE {BOUNDS}")
clean_views("ended", "ended_1")
query("clean_ledger_month_end", CLEANED, lambda t: c.clean_ledger(at_month_end(t), RULES, "dup_no"), opex_sql("ended_9"))
view("whole_1", "SELECT * EXCLUDE (dup_no) FROM dedup_first")
clean_views("whole", "whole_1")
view("whole_ledger", opex_sql("whole_9"))
query("clean_ledger_report",
      "series_id row_count:i first_date:d last_date:d "
      + " ".join(f"{x}_min:2 {x}_max:2 {x}_nulls:i" for x in MEASURES) + " date_nulls:i",
      lambda t: q.integrity_report(c.clean_ledger(t.dirty, RULES, "dup_no")),
      INTEGRITY + " FROM clean_ledger GROUP BY 1")
# A forecast with gaps, infinities and non-positive values, by rule from the FX column.
view("forecast_broken", f"""
SELECT series_id, date, CASE WHEN i % 7 = 3 OR i < 2 THEN NULL WHEN i % 11 = 5 THEN 'Infinity'::DOUBLE
       WHEN i = 9 AND series_id < 'C' THEN -1.0 ELSE sales_total_try END AS sales
FROM (SELECT *, {POSITION} - 1 AS i FROM ledger)""")


def broken_forecast(t):
    from ledgerloom.functions import windows as w
    i = F.col("i")
    sales = (F.when((i % 7 == 3) | (i < 2), F.lit(None)).when(i % 11 == 5, F.lit(float("inf")))
             .when((i == 9) & (F.col("series_id") < "C"), F.lit(-1.0)).otherwise(F.col(SALES)))
    return t.ledger.withColumn("i", w.position()).select("series_id", "date", sales.alias("sales"))


view("forecast_filled", f"""
SELECT * REPLACE (CASE WHEN isfinite(sales) THEN sales ELSE 3000000.0 END AS sales)
FROM ({interpolate('forecast_broken', 'sales', POSITION, both_ends=True)})""")
query("sanitize_forecast", "series_id date:d sales:2", lambda t: c.sanitize_forecast(broken_forecast(t)),
      f"""SELECT * REPLACE (CASE WHEN min(sales) OVER {WS} <= 0 THEN greatest(sales, 1000000.0) ELSE sales END AS sales)
          FROM forecast_filled""")

# --- Features --------------------------------------------------------------------------------------

PARTS = "year(date) AS year, month(date) AS month, quarter(date) AS quarter"
FLAGS = {"is_q4": "month(date) >= 10", "is_year_end": "month(date) = 12", "is_black_friday": "month(date) = 11",
         "is_ramadan": "month(date) = 5", "is_back_to_school": "month(date) = 9", "is_holiday_peak": "month(date) >= 11"}
query("calendar_parts", "series_id date:d year:i month:i quarter:i", lambda t: f.calendar_parts(t.ledger),
      f"SELECT *, {PARTS} FROM ledger")
query("calendar_flags", "series_id date:d " + " ".join(f"{k}:i" for k in FLAGS), lambda t: f.calendar_flags(t.ledger),
      "SELECT *, " + ", ".join(f"CAST({p} AS INT) AS {k}" for k, p in FLAGS.items()) + " FROM ledger")


def pct(col, k=1):
    return f"{col} / nullif(lag({col}, {k}) OVER {W}, 0) - 1"


view("growth", f"""
SELECT *, sales_growth_mom - lag(sales_growth_mom) OVER {W} AS growth_acceleration
FROM (SELECT *, {PARTS}, {pct('sales_total_try')} AS sales_growth_mom, {pct('usdtry')} AS fx_change_mom,
             {pct('sales_total_try', 12)} AS sales_growth_yoy FROM ledger)""")
query("growth_mom", "series_id date:d sales_growth_mom:6 fx_change_mom:6", lambda t: f.growth_mom(t.ledger),
      "SELECT * FROM growth")
query("growth_yoy", "series_id date:d sales_growth_yoy:6", lambda t: f.growth_yoy(t.ledger), "SELECT * FROM growth")
query("growth_acceleration", "series_id date:d growth_acceleration:6",
      lambda t: f.growth_acceleration(f.growth_mom(t.ledger)), "SELECT * FROM growth")
view("placed", f"""
SELECT *, {POSITION} - 1 AS pos, ({POSITION} - 1) / count(*) OVER {WS} AS elapsed,
       usdtry / nullif(first_value(usdtry) OVER {WALL}, 0) AS fx_rel FROM whole_ledger""")


def cleaned(t):
    return c.clean_ledger(t.dirty, WHOLE_RANGE, "dup_no")


def noise(stream):
    return normal(RANDOM_SEED, "series_id", 0, "pos", stream)


view("priced", f"""
SELECT *, 50000.0 * (0.6 + 0.4 * {clip('fx_rel', '0.5', '3.0')}) * (1.0 + 0.02 * elapsed) * (1.0 + 0.05 * {noise('price')}) AS raw_price
FROM placed""")
view("priced_smooth", f"SELECT *, avg(raw_price) OVER {near(1, 1)} AS avg_price_try FROM priced")
query("price_units", "series_id date:d avg_price_try:4 units_sold:4", lambda t: f.price_units(cleaned(t)),
      "SELECT *, greatest(sales_total_try / nullif(avg_price_try, 0), 0) AS units_sold FROM priced_smooth")
query("cogs_margin", "series_id date:d cogs_try:2 gross_margin_try:2", lambda t: f.cogs_margin(cleaned(t)),
      """SELECT *, sales_total_try - cogs_try AS gross_margin_try
         FROM (SELECT *, sales_total_try * 0.65 * (1.0 + 0.15 * (fx_rel - 1.0)) AS cogs_try FROM placed)""")
query("promo_intensity", "series_id date:d promo_intensity:6", lambda t: f.promo_intensity(cleaned(t)),
      f"""SELECT *, {clip('p', '0.0', '1.0')} AS promo_intensity FROM (SELECT *, 0.2 + 0.15 * sin(2 * pi() * (month(date) - 3) / 12)
          + CASE month(date) WHEN 11 THEN 0.3 WHEN 9 THEN 0.2 WHEN 5 THEN 0.15 ELSE 0.0 END + 0.03 * {noise('promo')} AS p FROM placed)""")
query("competitor_index", "series_id date:d competitor_index:6", lambda t: f.competitor_index(cleaned(t)),
      f"""SELECT *, {clip('p', '0.0', '100.0')} AS competitor_index FROM (SELECT *, 50.0 + 10 * sin(2 * pi() * (month(date) - 1) / 12 + pi())
          + 5.0 * elapsed + 8.0 * {noise('competitor')} AS p FROM placed)""")
