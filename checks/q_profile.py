"""Profiles and series analysis: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, view
from checks.sql_parts import POSITION, W, WS, eliminate, near
from ledgerloom.functions import unit_root
from ledgerloom.operators import features, profiling as p, series as s
from ledgerloom.params import FX, OPEX, SALES  # noqa: F401
from ledgerloom.sources.rollup import extract_series


def grown(t):
    return features.add_growth(t.ledger)


def sales(t):
    return extract_series(t.ledger, SALES)


query("growth_stats", "series_id sales_monthly_mean:6 sales_monthly_std:6 fx_monthly_mean:6 fx_monthly_std:6 volatility_ratio:6",
      lambda t: p.growth_stats(grown(t)),
      """SELECT *, sales_monthly_std / nullif(fx_monthly_std, 0) AS volatility_ratio
         FROM (SELECT series_id, avg(sales_growth_mom) AS sales_monthly_mean, stddev_samp(sales_growth_mom) AS sales_monthly_std,
                      avg(fx_change_mom) AS fx_monthly_mean, stddev_samp(fx_change_mom) AS fx_monthly_std FROM growth GROUP BY 1)""")


def t_tail_sql(t, dof):
    """Two-sided Student tail as the finite series over j, spelled with list functions."""
    theta = f"atan({t} / sqrt({dof}))"
    odd = f"""2.0 / pi() * ({theta} + sin({theta}) * list_sum(list_transform(range(0, ({dof} - 1) // 2),
        lambda j: cos({theta}) ** (2 * j + 1) * list_aggregate(list_concat([1.0::DOUBLE], list_transform(range(1, j + 1), lambda i: (2.0::DOUBLE * i) / (2 * i + 1))), 'product'))))"""
    even = f"""sin({theta}) * list_sum(list_transform(range(0, {dof} // 2),
        lambda j: cos({theta}) ** (2 * j) * list_aggregate(list_concat([1.0::DOUBLE], list_transform(range(1, j + 1), lambda i: (2.0::DOUBLE * i - 1) / (2 * i))), 'product')))"""
    return f"greatest(0.0, 1.0 - CASE WHEN {dof} % 2 = 1 THEN {odd} ELSE {even} END)"


view("trend_fit", f"""
SELECT series_id, count(*) - 2 AS dof, regr_slope(sales_total_try, pos) AS s_slope, regr_r2(sales_total_try, pos) AS s_r2,
       regr_slope(usdtry, pos) AS f_slope, regr_r2(usdtry, pos) AS f_r2
FROM (SELECT *, CAST({POSITION} - 1 AS DOUBLE) AS pos FROM ledger) GROUP BY 1""")
view("trend_t", """
SELECT *, sign(s_slope) * sqrt(s_r2 * dof / (1 - s_r2)) AS s_t, sign(f_slope) * sqrt(f_r2 * dof / (1 - f_r2)) AS f_t FROM trend_fit""")
query("linear_trend",
      "series_id sales_trend_slope:4 sales_trend_r_squared:6 sales_trend_t:6 sales_trend_p_value:6 "
      "fx_trend_slope:6 fx_trend_r_squared:6 fx_trend_t:6 fx_trend_p_value:6",
      lambda t: p.linear_trend(t.ledger),
      f"""SELECT series_id, s_slope AS sales_trend_slope, s_r2 AS sales_trend_r_squared, s_t AS sales_trend_t,
             {t_tail_sql('abs(s_t)', 'dof')} AS sales_trend_p_value, f_slope AS fx_trend_slope, f_r2 AS fx_trend_r_squared,
             f_t AS fx_trend_t, {t_tail_sql('abs(f_t)', 'dof')} AS fx_trend_p_value FROM trend_t""")
view("by_month", """
SELECT series_id, month(date) AS month, avg(sales_total_try) AS avg_sales, stddev_samp(sales_total_try) AS std_sales
FROM ledger GROUP BY 1, 2""")
query("month_profile", "series_id month:i avg_sales:2 std_sales:2 peak_month:i trough_month:i",
      lambda t: p.month_profile(t.ledger),
      f"""SELECT *, arg_max(month, avg_sales) OVER {WS} AS peak_month, arg_min(month, avg_sales) OVER {WS} AS trough_month
          FROM by_month""")
view("by_quarter", "SELECT series_id, quarter(date) AS quarter, avg(sales_total_try) AS avg_sales FROM ledger GROUP BY 1, 2")
query("quarter_profile", "series_id quarter:i avg_sales:2 q4_premium:6", lambda t: p.quarter_profile(t.ledger),
      f"""SELECT *, coalesce((max(avg_sales) FILTER (quarter = 4) OVER {WS} - avg(avg_sales) OVER {WS})
                 / avg(avg_sales) OVER {WS}, 0) AS q4_premium FROM by_quarter""")
query("year_end_effect", "series_id december_mean:2 other_mean:2 year_end_effect:6", lambda t: p.year_end_effect(t.ledger),
      """SELECT *, (december_mean - other_mean) / other_mean AS year_end_effect
         FROM (SELECT series_id, avg(sales_total_try) FILTER (month(date) = 12) AS december_mean,
                      avg(sales_total_try) FILTER (month(date) <> 12) AS other_mean FROM ledger GROUP BY 1)""")
query("detrended_strength", "series_id seasonal_strength:6", lambda t: p.detrended_strength(t.ledger),
      f"""SELECT f.series_id, stddev_pop(sales_total_try - icept - slope * pos) / stddev_pop(sales_total_try) AS seasonal_strength
          FROM (SELECT *, CAST({POSITION} - 1 AS DOUBLE) AS pos FROM ledger) l
          JOIN (SELECT series_id, regr_slope(sales_total_try, pos) AS slope, regr_intercept(sales_total_try, pos) AS icept
                FROM (SELECT *, CAST({POSITION} - 1 AS DOUBLE) AS pos FROM ledger) GROUP BY 1) f USING (series_id)
          GROUP BY 1""")
view("by_year", """
SELECT *, sales / lag(sales) OVER (PARTITION BY series_id ORDER BY year) - 1 AS sales_growth
FROM (SELECT series_id, year(date) AS year, sum(sales_total_try) AS sales, sum(opex_try) AS opex, avg(usdtry) AS fx
      FROM ledger GROUP BY 1, 2)""")
query("annual_totals", "series_id year:i sales:4 opex:4 fx:6 sales_growth:6", lambda t: p.annual_totals(t.ledger),
      "SELECT * FROM by_year")
query("annual_growth", "series_id average_annual_growth:6 cagr:6 years_analyzed:i", lambda t: p.annual_growth(t.ledger),
      """SELECT series_id, count(*) AS years_analyzed,
                CASE WHEN count(*) = 1 THEN 0 ELSE avg(sales_growth) END AS average_annual_growth,
                CASE WHEN count(*) = 1 THEN 0 ELSE (arg_max(sales, year) / arg_min(sales, year)) ** (1.0 / (count(*) - 1)) - 1 END AS cagr
         FROM by_year GROUP BY 1""")
query("growth_consistency", "series_id positive_growth_ratio:6 trend_direction", lambda t: p.growth_consistency(grown(t)),
      """SELECT g.series_id, positive_growth_ratio,
                CASE WHEN mean > 0.05 THEN 'Upward' WHEN mean < -0.05 THEN 'Downward' ELSE 'Stable' END AS trend_direction
         FROM (SELECT series_id, count(*) FILTER (sales_growth_mom > 0) / count(sales_growth_mom) AS positive_growth_ratio
               FROM growth GROUP BY 1) g
         JOIN (SELECT series_id, avg(sales_growth) AS mean FROM by_year GROUP BY 1) y USING (series_id)""")
query("correlation_matrix", "series_id sales_fx:6 sales_opex:6 fx_opex:6", lambda t: p.correlation_matrix(t.ledger),
      """SELECT series_id, corr(sales_total_try, usdtry) AS sales_fx, corr(sales_total_try, opex_try) AS sales_opex,
                corr(usdtry, opex_try) AS fx_opex FROM ledger GROUP BY 1""")
query("lagged_correlation", "series_id lag:i correlation:6", lambda t: p.lagged_correlation(t.ledger),
      " UNION ALL ".join(
          f"""SELECT series_id, {k} AS lag, coalesce(corr(sales_total_try, fx), 0) AS correlation
              FROM (SELECT *, lag(usdtry, {k}) OVER {W} AS fx FROM ledger) GROUP BY 1""" for k in range(1, 7)))


def rolling(c):
    return f"CASE WHEN count({c}) OVER {near(2, 0)} = 3 THEN stddev_samp({c}) OVER {near(2, 0)} END"


view("rolling_vol", f"SELECT *, {rolling('sales_growth_mom')} AS s_vol, {rolling('fx_change_mom')} AS f_vol FROM growth")
view("rolling_vol_cut", f"SELECT *, quantile_cont(s_vol, 0.75) OVER {WS} AS cut FROM rolling_vol")
query("rolling_volatility", "series_id sales_mean:6 sales_max:6 fx_mean:6 fx_max:6",
      lambda t: p.rolling_volatility(p.add_rolling_volatility(grown(t))),
      """SELECT series_id, avg(s_vol) AS sales_mean, max(s_vol) AS sales_max, avg(f_vol) AS fx_mean, max(f_vol) AS fx_max
         FROM rolling_vol GROUP BY 1""")
query("volatility_clusters", "series_id threshold:6 high_volatility_periods:i",
      lambda t: p.volatility_clusters(p.add_rolling_volatility(grown(t))),
      """SELECT series_id, max(cut) AS threshold, count(*) FILTER (s_vol > cut) AS high_volatility_periods
         FROM rolling_vol_cut GROUP BY 1""")
query("volatility_persistence", "series_id volatility_persistence:6",
      lambda t: p.volatility_persistence(p.add_rolling_volatility(grown(t))),
      f"""SELECT series_id, corr(s_vol, prev) AS volatility_persistence
          FROM (SELECT *, lag(s_vol) OVER {W} AS prev FROM rolling_vol) GROUP BY 1""")
view("ranked_sales", f"""
SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY sales_total_try DESC, date) AS rank,
       avg(usdtry) OVER {WS} AS mean_fx FROM ledger""")
query("top_periods", "series_id rank:i date:d sales_total_try:4 usdtry:6 avg_fx_during_peaks:6 fx_vs_average:6",
      lambda t: p.top_periods(t.ledger),
      f"""SELECT *, avg_fx_during_peaks / mean_fx - 1 AS fx_vs_average
          FROM (SELECT *, avg(usdtry) OVER {WS} AS avg_fx_during_peaks FROM ranked_sales WHERE rank <= 3)""")
query("top_acceleration", "series_id rank:i date:d growth_acceleration:6", lambda t: p.top_acceleration(grown(t)),
      """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY growth_acceleration DESC, date) AS rank
                        FROM growth WHERE growth_acceleration IS NOT NULL) WHERE rank <= 3""")
query("sensitivity_labels", "series_id growth_volatility_assessment fx_sensitivity_level",
      lambda t: p.sensitivity_labels(grown(t)),
      """SELECT series_id, CASE WHEN vol > 0.15 THEN 'High' WHEN vol > 0.08 THEN 'Moderate' ELSE 'Low' END AS growth_volatility_assessment,
                CASE WHEN c > 0.5 THEN 'High' WHEN c > 0.3 THEN 'Moderate' ELSE 'Low' END AS fx_sensitivity_level
         FROM (SELECT series_id, stddev_samp(sales_growth_mom) AS vol, abs(corr(sales_total_try, usdtry)) AS c FROM growth GROUP BY 1)""")

# --- Series analysis -------------------------------------------------------------------------------

view("sales_series", "SELECT series_id, date, sales_total_try AS value FROM ledger")
query("series_stats",
      "series_id total_observations:i first_date:d last_date:d completeness:6 mean:2 std:2 cv:6 trend_direction",
      lambda t: s.series_stats(sales(t)),
      f"""SELECT series_id, count(*) AS total_observations, min(date) AS first_date, max(date) AS last_date,
             count(value) / count(*) * 100 AS completeness, avg(value) AS mean, stddev_samp(value) AS std,
             stddev_samp(value) / avg(value) AS cv,
             CASE WHEN avg(value) FILTER (back <= 12) > avg(value) FILTER (ahead <= 12) THEN 'increasing' ELSE 'decreasing' END AS trend_direction
          FROM (SELECT *, row_number() OVER {W} AS ahead, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back
                FROM sales_series) GROUP BY 1""")
def unit_root_views(p, source):
    """Views with the prefix p: every number of lagged changes by elimination on shared rows, the one of least AIC once more on all of its own."""
    lags = range(1, 13)
    view(f"{p}steps", f"""
SELECT *, {', '.join(f'lag(delta, {k}) OVER {W} AS d{k}' for k in lags)} FROM (
  SELECT *, {POSITION} - 1 AS pos, lag(value) OVER {W} - avg(value) OVER (PARTITION BY series_id) AS level, value - lag(value) OVER {W} AS delta FROM {source})""")
    view(f"{p}sizes", f"""
SELECT series_id, count(*) AS n, CAST(least(ceil(12 * (count(*) / 100) ** 0.25), count(*) // 2 - 2) AS INT) AS most, min(value) = max(value) AS still FROM {source} GROUP BY 1""")
    view(f"{p}tries", f"SELECT series_id, n, most AS lost, unnest(range(0, most + 1)) AS k FROM {p}sizes WHERE most >= 0")

    def system(name, tries):
        x = f"[1.0::DOUBLE, level, {', '.join(f'd{k}' for k in lags)}, delta]"
        view(f"{p}{name}_cells", f"""
SELECT series_id, k, i, j, sum(x[i] * x[j]) AS c FROM (SELECT t.series_id, t.k, {x} AS x FROM {tries} t JOIN {p}steps s ON s.series_id = t.series_id WHERE s.pos > t.lost)
CROSS JOIN (SELECT unnest(range(1, 16)) AS i) CROSS JOIN (SELECT unnest(range(1, 16)) AS j) WHERE (i <= k + 2 OR i = 15) AND (j <= k + 2 OR j = 15) GROUP BY ALL""")
        view(f"{p}{name}_m", f"""
SELECT series_id, k AS form, list(list_append(r, CASE WHEN i = 2 THEN 1.0 ELSE 0.0 END) ORDER BY i) AS m
FROM (SELECT series_id, k, i, list(c ORDER BY j) AS r FROM {p}{name}_cells WHERE i < 15 GROUP BY ALL) GROUP BY ALL""")
        view(f"{p}{name}_c", eliminate(f"{p}{name}_m"))
        view(f"{p}{name}_fit", f"""
SELECT c.series_id, c.form AS k, any_value(c.coef) AS coef, any_value(c.sides[2][2]) AS spread, any_value(y.c) AS total,
  any_value(y.c) - sum(c.coef[q.i] * q.c) AS sse
FROM {p}{name}_c c JOIN {p}{name}_cells q ON q.series_id = c.series_id AND q.k = c.form AND q.j = 15 AND q.i < 15
JOIN {p}{name}_cells y ON y.series_id = c.series_id AND y.k = c.form AND y.i = 15 AND y.j = 15 GROUP BY 1, 2""")

    system("try", f"{p}tries")
    view(f"{p}won", f"""
SELECT t.series_id, t.n, t.k, t.k AS lost FROM {p}tries t JOIN {p}try_fit f ON f.series_id = t.series_id AND f.k = t.k
QUALIFY row_number() OVER (PARTITION BY t.series_id ORDER BY (t.n - 1 - t.lost) * ln(greatest(sse / (t.n - 1 - t.lost), 1e-300)) + 2 * (t.k + 2), t.k) = 1""")
    system("own", f"{p}won")
    levels = ", ".join(f"CASE WHEN df_statistic IS NOT NULL THEN {' + '.join(f'({c}) / n_obs ** {i}' for i, c in enumerate(cs))} END AS critical_{level}" for level, cs in unit_root.CRITICAL.items())
    poly = lambda cs: " + ".join(f"({c}) * df_statistic ** {i}" for i, c in enumerate(cs))
    tail = "list_sum(list_transform(range(0, 120), lambda i: exp((2 * i + 1) * ln(abs(x)) - list_sum(list_transform(range(0, i + 1), lambda q: ln(2 * q + 1))))))"
    view(f"{p}test", f"""
SELECT *, p_value < 0.05 AS is_stationary FROM (
  SELECT *, CASE WHEN df_statistic > {unit_root.ALL} THEN 1 WHEN df_statistic < {unit_root.NONE} THEN 0
    ELSE 0.5 + sign(x) * exp(-x * x / 2) / sqrt(2 * pi()) * {tail} END AS p_value, {levels} FROM (
    SELECT *, CASE WHEN df_statistic <= {unit_root.TURN} THEN {poly(unit_root.LOWER)} ELSE {poly(unit_root.UPPER)} END AS x FROM (
      SELECT z.series_id, coalesce(z.n - 1 - w.k, 0) AS n_obs, CASE WHEN s IS NOT NULL THEN w.k END AS lags, s AS df_statistic FROM {p}sizes z LEFT JOIN {p}won w ON w.series_id = z.series_id
      LEFT JOIN (
        SELECT f.series_id, coef[2] / sqrt(sse / (n - 3 - 2 * f.k) * spread) AS s FROM {p}own_fit f JOIN {p}won o ON o.series_id = f.series_id
        WHERE n - 3 - 2 * f.k > 0 AND sse > 1e-12 * total) t ON t.series_id = z.series_id AND NOT z.still)))""")


unit_root_views("df_", "sales_series")
TEST = "series_id n_obs:i lags:i df_statistic:6 p_value:6 critical_1pct:6 critical_5pct:6 critical_10pct:6 is_stationary:b"
query("stationarity", TEST, lambda t: s.stationarity(sales(t)), "SELECT * FROM df_test")
# Series of 2, 13 and 24 months: what cannot be computed is null, and no series is missing.
view("tiny_series", "SELECT * FROM sales_series WHERE date < DATE '1995-03-01' + to_months(CAST(ascii(series_id) % 3 AS INT) * 11)")


def tiny(t):
    return sales(t).where(F.col("date") < F.add_months(F.lit("1995-03-01").cast("date"), F.ascii("series_id") % 3 * 11))


unit_root_views("dt_", "tiny_series")
query("stationarity_short", TEST, lambda t: s.stationarity(tiny(t)), "SELECT * FROM dt_test")
query("decompose_short", "series_id date:d value:4 trend:2 seasonal:2 residual:2", lambda t: s.decompose_additive(tiny(t)),
      f"""WITH t AS (SELECT *, {POSITION} - 1 AS pos, count(*) OVER {WS} AS n,
            CASE WHEN count(*) OVER {near(6, 6)} = 13 AND count(*) OVER {WS} >= 24 THEN
              (0.5 * (lag(value, 6) OVER {W} + lead(value, 6) OVER {W}) + sum(value) OVER {near(5, 5)}) / 12 END AS trend FROM tiny_series),
          slot AS (SELECT series_id, pos % 12 AS slot, avg(value - trend) AS mean FROM t GROUP BY 1, 2),
          wave AS (SELECT series_id, slot, mean - avg(mean) OVER {WS} AS seasonal FROM slot)
          SELECT t.series_id, date, value, trend, seasonal, value - trend - seasonal AS residual
          FROM t JOIN wave ON wave.series_id = t.series_id AND slot = pos % 12""")
view("dec_trend", f"""
SELECT *, {POSITION} - 1 AS pos, count(*) OVER {WS} AS n,
  CASE WHEN count(*) OVER {near(6, 6)} = 13 THEN
    (0.5 * (lag(value, 6) OVER {W} + lead(value, 6) OVER {W}) + sum(value) OVER {near(5, 5)}) / 12 END AS trend FROM sales_series""")
view("dec_slot", "SELECT series_id, pos % 12 AS slot, avg(value - trend) AS mean FROM dec_trend WHERE n >= 24 GROUP BY 1, 2")
view("dec_season", f"SELECT series_id, slot, mean - avg(mean) OVER {WS} AS seasonal FROM dec_slot")
view("dec_parts", """
SELECT d.series_id, date, value, trend, seasonal, value - trend - seasonal AS residual
FROM dec_trend d JOIN dec_season s ON s.series_id = d.series_id AND slot = pos % 12 WHERE n >= 24""")
query("decompose_additive", "series_id date:d value:4 trend:2 seasonal:2 residual:2", lambda t: s.decompose_additive(sales(t)),
      "SELECT * FROM dec_parts")
query("decomposition_strength", "series_id seasonal_strength:6 trend_strength:6 has_seasonality:b has_trend:b",
      lambda t: s.decomposition_strength(s.decompose_additive(sales(t))),
      """SELECT *, seasonal_strength > 0.1 AS has_seasonality, trend_strength > 0.1 AS has_trend
         FROM (SELECT series_id, stddev_pop(seasonal) / stddev_pop(value) AS seasonal_strength,
                      stddev_pop(trend) / stddev_pop(value) AS trend_strength FROM dec_parts GROUP BY 1)""")
view("centred", f"SELECT series_id, {POSITION} AS i, count(*) OVER {WS} AS n, value - avg(value) OVER {WS} AS c FROM sales_series")
view("autocov", """
SELECT a.series_id, a.n, k AS lag, sum(a.c * b.c) AS s
FROM centred a JOIN (SELECT unnest(range(0, 41)) AS k) ON true JOIN centred b ON b.series_id = a.series_id AND b.i = a.i - k
GROUP BY 1, 2, 3""")
view("acf", """
SELECT series_id, n, lag, s / first_value(s) OVER (PARTITION BY series_id ORDER BY lag) AS acf FROM autocov""")
query("autocorrelation", "series_id lag:i acf:6 is_significant:b", lambda t: s.autocorrelation(sales(t)),
      "SELECT *, lag BETWEEN 1 AND 12 AND abs(acf) > 0.2 AS is_significant FROM acf WHERE lag <= n // 4")
# Durbin-Levinson by lag: phi is the list of coefficients of the order before.
view("rho_adjusted", """
SELECT series_id, max(n) AS n, list((s / (n - lag)) / (s0 / n) ORDER BY lag) AS r
FROM (SELECT *, first_value(s) OVER (PARTITION BY series_id ORDER BY lag) AS s0 FROM autocov) GROUP BY 1""")
query("partial_autocorrelation", "series_id lag:i pacf:6", lambda t: s.partial_autocorrelation(sales(t)),
      """WITH RECURSIVE dl AS (
           SELECT series_id, 0 AS lag, n, r, []::DOUBLE[] AS phi, 1.0::DOUBLE AS pacf FROM rho_adjusted
           UNION ALL
           SELECT series_id, lag + 1, n, r,
                  list_concat(list_transform(range(1, lag + 1), lambda j: phi[j] - a * phi[lag + 1 - j]), [a]), a
           FROM (SELECT *, (r[lag + 2] - coalesce(list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[lag + 2 - j])), 0))
                           / (1 - coalesce(list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[j + 1])), 0)) AS a
                 FROM dl WHERE lag < least(20, n // 8)))
         SELECT series_id, lag, pacf FROM dl""")
FIT = f"""
SELECT series_id, date, value, max(date) OVER {WS} AS last_date, count(*) OVER {WS} AS n_rows,
       row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back FROM {{src}} WHERE value IS NOT NULL"""
view("trend_recent", FIT.format(src="sales_series"))
view("trend_line", """
SELECT series_id, max(last_date) AS last_date, regr_slope(value, -back) AS slope, regr_intercept(value, -back) AS icept,
       arg_min(value, back) AS last FROM trend_recent WHERE back <= 12 GROUP BY 1""")
query("trend_forecast", "series_id step:i date:d forecast:2", lambda t: s.trend_forecast(sales(t)),
      """SELECT series_id, step, CAST(last_date + to_months(CAST(step AS INT)) AS DATE) AS date,
                greatest(icept + slope * (step - 1), 0.5 * last) AS forecast
         FROM trend_line CROSS JOIN (SELECT unnest(range(1, 19)) AS step)""")
