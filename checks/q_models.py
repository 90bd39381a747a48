"""Models, accuracy and forecasts: queries and their SQL.

The SQL fits the models by other means than the engine does: recursion over rows for smoothing, elimination on
lists for least squares, and window frames for differences.
"""

from __future__ import annotations

from dataclasses import replace
from statistics import NormalDist

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.q_profile import sales
from checks.registry import query, view
from checks.sql_parts import POSITION, W, WS, eliminate, interpolate
from ledgerloom.functions import arima as ar, smoothing as sm
from ledgerloom.operators import features, forecasting as fc, models as m
from ledgerloom.operators.series import trend_forecast
from ledgerloom.params import SALES, Forecasting
from ledgerloom.plans.lineage import cut
from ledgerloom.sources.rollup import dedup_first

SETTINGS = Forecasting()
Z = NormalDist().inv_cdf(0.975)
GRID = "(VALUES " + ", ".join(f"({g}::DOUBLE)" for g in SETTINGS.grid) + ")"
ZERO = "(VALUES (0.0::DOUBLE))"
MOVES = "(SELECT unnest([-1, 0, 1]) AS d)"


MONTH = "(year(date) * 12 + month(date))"


def model_views(p, source, horizon, season=12, stored=None):
    """Views named with the prefix p: fits, fitted values and forecasts of every series in `source`. Models are fitted anew, or taken from the views
    with the prefix `stored`."""
    # The month axis: every month from the first known value to the last, those in between on a straight line.
    view(f"{p}axis", f"""
SELECT s.series_id, s.date, v.value, v.value IS NOT NULL AS known
FROM (SELECT series_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS DATE) AS date
      FROM {source} WHERE value IS NOT NULL GROUP BY 1) s
LEFT JOIN (SELECT * FROM {source} WHERE value IS NOT NULL) v ON v.series_id = s.series_id AND v.date = s.date""")
    view(f"{p}line", interpolate(f"{p}axis", "value", MONTH))
    view(f"{p}placed", f"SELECT series_id, date, value, known, {POSITION} - 1 AS pos, count(*) OVER {WS} AS n FROM {p}line")
    view(f"{p}pos", f"""
SELECT * FROM {p}placed JOIN (SELECT series_id, max(n) AS span FROM {stored or p}placed GROUP BY 1) USING (series_id)""")
    size = {f: sm.size(f, season) for f in SETTINGS.ets_forms}
    view(f"{p}months", f"""
SELECT series_id, step, CAST(max(date) + to_months(CAST(step AS INT)) AS DATE) AS date, max(n) AS n, max(span) AS span
FROM {p}pos CROSS JOIN (SELECT unnest(range(1, {horizon + 1})) AS step) GROUP BY 1, 2""")
    # Smoothing.
    grids = " UNION ALL ".join(
        f"""SELECT '{f}' AS form, {size[f]} AS k, a.col0 AS alpha, b.col0 AS beta, c.col0 AS gamma
            FROM {GRID} a CROSS JOIN {GRID if f[1] == 'A' else ZERO} b CROSS JOIN {GRID if f[2] != 'N' else ZERO} c"""
        for f in SETTINGS.ets_forms)
    view(f"{p}grid", grids)
    view(f"{p}start", f"""
SELECT series_id, n, m1, (m2 - m1) / {season} AS slope, firsts, smallest FROM (
  SELECT series_id, max(n) AS n, min(value) AS smallest, avg(value) FILTER (pos < {season}) AS m1,
         avg(value) FILTER (pos BETWEEN {season} AND {2 * season - 1}) AS m2,
         list(value ORDER BY pos) FILTER (pos < {season}) AS firsts FROM {p}pos GROUP BY 1)""")

    def recursion(candidates):
        return f"""
WITH RECURSIVE r AS (
  SELECT series_id, form, k, alpha, beta, gamma, n, -1::BIGINT AS pos, l0 AS l, 0.0::DOUBLE AS expected, b0 AS b,
         CASE form[3] WHEN 'A' THEN list_transform(firsts, lambda v, i: v - (l0 + b0 * i))
                      WHEN 'M' THEN list_transform(firsts, lambda v, i: v / (l0 + b0 * i)) ELSE []::DOUBLE[] END AS s, 0.0::DOUBLE AS sse
  FROM (SELECT *, m1 - b0 * {(season + 1) / 2} AS l0 FROM (
        SELECT *, CASE WHEN form[2] = 'A' THEN slope ELSE 0 END AS b0 FROM {candidates} JOIN {p}start USING (series_id)))
  UNION ALL
  SELECT series_id, form, k, alpha, beta, gamma, n, pos + 1,
         alpha * CASE form[3] WHEN 'A' THEN v - s[1] WHEN 'M' THEN v / s[1] ELSE v END + (1 - alpha) * base,
         CASE form[3] WHEN 'A' THEN base + s[1] WHEN 'M' THEN base * s[1] ELSE base END,
         CASE WHEN form[2] = 'A' THEN beta * (alpha * CASE form[3] WHEN 'A' THEN v - s[1] WHEN 'M' THEN v / s[1] ELSE v END + (1 - alpha) * base - l) + (1 - beta) * b ELSE b END,
         CASE form[3] WHEN 'A' THEN list_concat(s[2:{season}], [gamma * (v - base) + (1 - gamma) * s[1]])
                      WHEN 'M' THEN list_concat(s[2:{season}], [gamma * (v / base) + (1 - gamma) * s[1]]) ELSE s END,
         sse + (v - CASE form[3] WHEN 'A' THEN base + s[1] WHEN 'M' THEN base * s[1] ELSE base END) ** 2
  FROM (SELECT r.*, q.value AS v, CASE WHEN form[2] = 'A' THEN l + b ELSE l END AS base
        FROM r JOIN {p}pos q ON q.series_id = r.series_id AND q.pos = r.pos + 1))
SELECT * FROM r"""

    fit_smoothing = stored is None
    view(f"{p}candidates", f"""
SELECT s.series_id, g.* FROM {p}grid g CROSS JOIN {p}start s WHERE (form = 'ANN' OR s.n >= {2 * season}) AND (form[3] <> 'M' OR s.smallest > 0)""")
    # The grid's best weights of every form, then the best of their neighbours at smaller and smaller steps.
    view(f"{p}moves", " UNION ALL ".join(
        f"""SELECT '{f}' AS form, a.d AS da, {'b.d' if f[1] == 'A' else '0'} AS db, {'c.d' if f[2] != 'N' else '0'} AS dc
            FROM {MOVES} a{f' CROSS JOIN {MOVES} b' if f[1] == 'A' else ''}{f' CROSS JOIN {MOVES} c' if f[2] != 'N' else ''}""" for f in SETTINGS.ets_forms))
    weight = lambda w, d, step, used: f"CASE WHEN {used} THEN greatest({sm.LEAST}::DOUBLE, least({sm.MOST}::DOUBLE, {w} + {d} * {step}::DOUBLE)) ELSE 0.0::DOUBLE END AS {w}"
    for r, step in enumerate((*sm.STEPS, None) if fit_smoothing else ()):
        view(f"{p}tried{r}", f"SELECT * EXCLUDE (s) FROM ({recursion(p + 'candidates' if r == 0 else f'{p}candidates{r}')}) WHERE pos = n - 1")
        view(f"{p}winners{r}", f"""
SELECT series_id, form, k, alpha, beta, gamma, sse, n FROM {p}tried{r}
QUALIFY row_number() OVER (PARTITION BY series_id, form ORDER BY sse, alpha, beta, gamma) = 1""")
        if step is not None:
            view(f"{p}candidates{r + 1}", f"""
SELECT series_id, form, k, {weight('alpha', 'da', step, 'true')}, {weight('beta', 'db', step, "form[2] = 'A'")}, {weight('gamma', 'dc', step, "form[3] <> 'N'")}
FROM {p}winners{r} JOIN {p}moves USING (form)""")
    if fit_smoothing:
        view(f"{p}form_winners", f"SELECT series_id, form, k, alpha, beta, gamma FROM {p}winners{len(sm.STEPS)}")
        view(f"{p}form_path", recursion(p + "form_winners"))
    view(f"{p}ets", f"SELECT * FROM {stored}ets" if stored else f"""
SELECT series_id, form, k, alpha, beta, gamma, sse, n * ln(sse / n) + 2 * k AS aic, sqrt(sse / n) AS sigma FROM {p}winners{len(sm.STEPS)}
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY n * ln(sse / n) + 2 * k, form) = 1""")
    view(f"{p}winners", f"SELECT series_id, form, k, alpha, beta, gamma FROM {p}ets")
    view(f"{p}path", recursion(p + "winners"))
    # Seasonal autoregression with moving averages: w and its errors by a long autoregression, then w on the lags of both.
    by = "OVER (PARTITION BY series_id ORDER BY pos)"
    view(f"{p}w", f"""
SELECT *, value - lag(value, 1) OVER {W} - lag(value, {season}) OVER {W} + lag(value, {season + 1}) OVER {W} AS w FROM {p}pos""")
    long = (1, 2, 3, season, season + 1)
    view(f"{p}x", f"""
SELECT *, {', '.join(f'coalesce(lag(w, {k}) {by}, 0) AS x{k}' for k in long)} FROM {p}w WHERE w IS NOT NULL AND n >= {ar.least(season)}""")

    def normal(src, names, form):
        rows = ", ".join("[" + ", ".join(f"sum({a_} * {b_})" for b_ in (*names, "w")) + "]" for a_ in names)
        return f"SELECT series_id, '{form}' AS form, [{rows}] AS m FROM {src} GROUP BY 1"

    view(f"{p}long_m", normal(f"{p}x", [f"x{k}" for k in long], "long"))
    view(f"{p}long", eliminate(f"{p}long_m"))
    view(f"{p}e", f"SELECT *, w - {' - '.join(f'coef[{i + 1}] * x{k}' for i, k in enumerate(long))} AS e FROM {p}x JOIN {p}long USING (series_id)")
    view(f"{p}xe", f"SELECT * EXCLUDE (form, coef, sides, logdet), {', '.join(f'coalesce(lag(e, {k}) {by}, 0) AS e{k}' for k in (1, 2, season))} FROM {p}e")
    inside = lambda c, edge="1": f"greatest(-{ar.EDGE} * ({edge}), least({ar.EDGE} * ({edge}), {c}))"
    estimates = []
    for i, (form, (na, nm, sa, sm_)) in enumerate(ar.ORDERS.items()):
        names = [*[f"x{k}" for k in (*range(1, na + 1), *[season] * sa)], *[f"e{k}" for k in (*range(1, nm + 1), *[season] * sm_)]]
        view(f"{p}ar_m{i}", normal(f"{p}xe", names, form))
        view(f"{p}ar_c{i}", eliminate(f"{p}ar_m{i}"))
        c = lambda name: f"coef[{names.index(name) + 1}]" if name in names else "0.0::DOUBLE"  # noqa: E731, B023
        phi2, theta2 = inside(c("x2")), f"-({inside('-' + c('e2'))})"
        estimates.append(f"""
SELECT series_id, form, {na + nm + sa + sm_} AS k, {i} AS nr, {inside(c('x1'), f'1 - {phi2}')} AS phi1, {phi2} AS phi2, -({inside('-' + c('e1'), f'1 + {theta2}')}) AS theta1,
  {theta2} AS theta2, {inside(c(f'x{season}'))} AS sphi, {inside(c(f'e{season}'))} AS stheta FROM {p}ar_c{i}""")
    view(f"{p}ar_all", f"SELECT series_id, form, k, nr, {', '.join(ar.PARAMS)} FROM {stored}ar" if stored else " UNION ALL ".join(estimates))
    # Channels: the series, and for each unknown month one that is 1 there. Errors are linear in them.
    view(f"{p}chan", f"""
SELECT series_id, 0 AS ch, pos, value AS v FROM {p}pos WHERE n >= {ar.least(season)}
UNION ALL SELECT a.series_id, a.pos + 1, b.pos, CASE WHEN a.pos = b.pos THEN 1.0 ELSE 0.0 END FROM {p}pos a JOIN {p}pos b USING (series_id) WHERE NOT a.known AND a.n >= {ar.least(season)}""")
    of = "OVER (PARTITION BY series_id, ch ORDER BY pos)"
    zeros = f"list_transform(range({season + 2}), lambda x: 0.0::DOUBLE)"
    view(f"{p}chan_w", f"""
SELECT series_id, ch, list_concat({zeros}, list(w ORDER BY pos)) AS ws FROM (
  SELECT *, v - lag(v, 1) {of} - lag(v, {season}) {of} + lag(v, {season + 1}) {of} AS w FROM {p}chan) WHERE w IS NOT NULL GROUP BY ALL""")
    pairs_of = {1: ("phi1", "theta1"), 2: ("phi2", "theta2"), season: ("sphi", "stheta"), season + 1: ("-phi1 * sphi", "theta1 * stheta"),
                season + 2: ("-phi2 * sphi", "theta2 * stheta")}
    view(f"{p}ar_filter", f"""
WITH RECURSIVE r AS (
  SELECT *, {season + 2} AS t, {zeros} AS es FROM {p}ar_all JOIN {p}chan_w USING (series_id)
  UNION ALL
  SELECT * EXCLUDE (t, es), t + 1, list_append(es, ws[t + 1] - {' - '.join(f'(({a_}) * ws[t + 1 - {k}] + ({b_}) * es[t + 1 - {k}])' for k, (a_, b_) in pairs_of.items())})
  FROM r WHERE t < len(ws))
SELECT * FROM r WHERE t = len(ws)""")
    view(f"{p}ar_cells", f"""
SELECT a.series_id, a.form, a.ch AS i, b.ch AS j, CASE WHEN b.ch = 0 THEN -1 ELSE 1 END * list_dot_product(a.es, b.es) AS c
FROM {p}ar_filter a JOIN {p}ar_filter b USING (series_id, form) WHERE a.ch > 0""")
    view(f"{p}ar_un_m", f"""
SELECT series_id, form, list(r ORDER BY i) AS m FROM (
  SELECT series_id, form, i, list(c ORDER BY j = 0, j) AS r FROM {p}ar_cells GROUP BY ALL) GROUP BY ALL""")
    view(f"{p}ar_un", eliminate(f"{p}ar_un_m", 0))
    view(f"{p}ar_share", f"""
SELECT f.series_id, f.form, f.ch, CASE WHEN f.ch = 0 THEN 1.0::DOUBLE ELSE u.coef[row_number() OVER (PARTITION BY f.series_id, f.form ORDER BY f.ch) - 1] END AS c
FROM {p}ar_filter f LEFT JOIN {p}ar_un u ON u.series_id = f.series_id AND u.form = f.form""")
    view(f"{p}ar_es", f"""
SELECT series_id, form, t, sum(c * e) AS e FROM (
  SELECT series_id, form, ch, unnest(es[{season + 3}:]) AS e, unnest(range(len(es) - {season + 2})) AS t FROM {p}ar_filter) JOIN {p}ar_share USING (series_id, form, ch)
GROUP BY ALL""")
    view(f"{p}ar", (f"SELECT q.* EXCLUDE (sigma), o.sigma FROM {p}ar_own q JOIN {stored}ar o ON o.series_id = q.series_id" if stored else f"SELECT * FROM {p}ar_own"))
    view(f"{p}ar_own", f"""
SELECT *, months * ln(sse / months) + logdet + 2 * (k + 1) AS aic, sqrt(sse / months) AS sigma FROM (
  SELECT a.*, s.sse, s.w_months - coalesce(len(u.coef), 0) AS months, coalesce(u.logdet, 0) AS logdet FROM {p}ar_all a
  JOIN (SELECT series_id, form, sum(e * e) AS sse, count(*) AS w_months FROM {p}ar_es GROUP BY ALL) s ON s.series_id = a.series_id AND s.form = a.form
  LEFT JOIN {p}ar_un u ON u.series_id = a.series_id AND u.form = a.form) WHERE months > k + 1
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY months * ln(sse / months) + logdet + 2 * (k + 1), nr) = 1""")
    view(f"{p}ar_y", f"""
SELECT a.series_id, v.pos, sum(s.c * v.v) AS y FROM {p}ar a JOIN {p}ar_share s ON s.series_id = a.series_id AND s.form = a.form
JOIN {p}chan v ON v.series_id = a.series_id AND v.ch = s.ch GROUP BY ALL""")
    view(f"{p}ar_end", f"""
SELECT *, list_concat({zeros}, list_transform(range({season + 2}, len(ys) + 1), lambda t: ys[t] - ys[t - 1] - ys[t - {season}] + ys[t - {season + 1}])) AS ws FROM (
  SELECT a.*, y.ys, list_concat({zeros}, e.es) AS es FROM {p}ar a
  JOIN (SELECT series_id, list(y ORDER BY pos) AS ys FROM {p}ar_y GROUP BY 1) y ON y.series_id = a.series_id
  JOIN (SELECT series_id, form, list(e ORDER BY t) AS es FROM {p}ar_es GROUP BY ALL) e ON e.series_id = a.series_id AND e.form = a.form)""")

    def continued(src):
        return f"""
WITH RECURSIVE r AS (
  SELECT *, 0 AS step FROM {src}
  UNION ALL
  SELECT * EXCLUDE (step, ys, ws, es, d), list_append(ys, d + ys[-1] + ys[-{season}] - ys[-{season + 1}]) AS ys, list_append(ws, d) AS ws, list_append(es, 0.0::DOUBLE) AS es, step + 1
  FROM (SELECT *, {' + '.join(f'(({a_}) * ws[-{k}] + ({b_}) * es[-{k}])' for k, (a_, b_) in pairs_of.items())} AS d FROM r WHERE step < {horizon}))
SELECT series_id, step, ys[-1] AS forecast FROM r"""

    keep = "series_id, phi1, phi2, theta1, theta2, sphi, stheta"
    view(f"{p}ar_from", f"SELECT {keep}, ys, ws, es FROM {p}ar_end")
    hit = f"list_append({zeros}, 1.0::DOUBLE)"
    view(f"{p}ar_hit", f"SELECT {keep}, {hit} AS ys, {hit} AS ws, {hit} AS es FROM {p}ar")
    view(f"{p}ar_ahead", f"SELECT * FROM ({continued(f'{p}ar_from')}) WHERE step > 0")
    view(f"{p}ar_weights", continued(f"{p}ar_hit"))
    fitted = [
        f"SELECT series_id, 'ets' AS model, date, value AS actual, expected AS predicted FROM {p}pos JOIN {p}path USING (series_id, pos) WHERE known",
        f"""SELECT q.series_id, 'ar' AS model, q.date, q.value AS actual, q.value - e.e AS predicted FROM {p}ar a
            JOIN {p}pos q ON q.series_id = a.series_id
            LEFT JOIN {p}ar_es e ON e.series_id = a.series_id AND e.form = a.form AND q.pos = e.t + {season + 1} WHERE q.known""",
    ]
    ahead = [
        f"SELECT series_id, 'ar' AS model, step, forecast FROM {p}ar_ahead",
        f"""SELECT series_id, 'ets' AS model, step,
            CASE form[3] WHEN 'A' THEN l + b * step + s[(step - 1) % {season} + 1] WHEN 'M' THEN (l + b * step) * s[(step - 1) % {season} + 1]
                 ELSE l + b * step END AS forecast
            FROM {p}path JOIN {p}months USING (series_id) WHERE pos = {p}path.n - 1""",
    ]
    # How far an error reaches, j months on; the multiplicative season to first order.
    reach = f"""alpha * (1 + beta * (step - i)) * CASE WHEN form[3] = 'M' THEN s[(step - 1) % {season} + 1] / s[(i - 1) % {season} + 1] ELSE 1 END
      + CASE WHEN (step - i) % {season} = 0 AND form[3] <> 'N' THEN gamma * CASE WHEN form[3] = 'M' THEN (l + b * step) / (l + b * i) ELSE 1 END ELSE 0 END"""
    spreads = [
        f"""SELECT series_id, 'ets' AS model, step, sigma * sqrt(1 + coalesce(list_sum(list_transform(range(1, step), lambda i: ({reach}) ** 2)), 0)) AS spread
            FROM (SELECT * EXCLUDE (sse) FROM {p}path) q JOIN (SELECT series_id, sigma FROM {p}ets) USING (series_id) JOIN {p}months d USING (series_id) WHERE pos = q.n - 1""",
        f"""SELECT a.series_id, 'ar' AS model, step + 1 AS step, sigma * sqrt(sum(forecast * forecast) OVER (PARTITION BY a.series_id ORDER BY step)) AS spread
            FROM {p}ar_weights w JOIN {p}ar a ON a.series_id = w.series_id WHERE step < {horizon}""",
    ]
    def design(pos, month):
        waves = ", ".join(f"{f}(2 * pi() * {k} * ({month} - 1) / 12)" for k in (1, 2, 3) for f in ("sin", "cos"))
        bends = ", ".join(f"greatest(0, {pos} / span - 0.8::DOUBLE * {k} / {SETTINGS.knots + 1})" for k in range(1, SETTINGS.knots + 1))
        return f"[1.0::DOUBLE, {pos} / span, {waves}, {bends}]"

    sides = SETTINGS.knots + 8

    view(f"{p}design", f"SELECT *, {design('pos', 'month(date)')} AS x FROM {p}pos")
    view(f"{p}normal_cells", f"""
SELECT series_id, i, j, sum(xv[i] * xv[j]) AS c
FROM (SELECT series_id, list_append(x, value) AS xv FROM {p}design WHERE known)
CROSS JOIN (SELECT unnest(range(1, {sides + 1})) AS i) CROSS JOIN (SELECT unnest(range(1, {sides + 2})) AS j) GROUP BY series_id, i, j HAVING count(*) > 9""")
    view(f"{p}ahead_x", f"SELECT series_id, step, {design('(n - 1 + step)', 'month(date)')} AS x FROM {p}months")
    view(f"{p}sides", f"SELECT series_id, i, list(x[i] ORDER BY step) AS r FROM {p}ahead_x CROSS JOIN (SELECT unnest(range(1, {sides + 1})) AS i) GROUP BY ALL")
    # Beside the values: the forecasts' designs and the unpenalised cross products, whose solutions have the free coefficients on the diagonal.
    view(f"{p}normal", f"""
SELECT series_id, CAST(penalty AS VARCHAR) AS form,
  list(list_concat(list_transform(q.r, lambda v, j: v + CASE WHEN j = i AND i > 8 THEN penalty ELSE 0 END), a.r, q.r[:{sides}]) ORDER BY i) AS m
FROM (SELECT series_id, i, list(c ORDER BY j) AS r FROM {stored or p}normal_cells GROUP BY ALL) q JOIN {p}sides a USING (series_id, i)
CROSS JOIN (SELECT unnest({list(SETTINGS.knot_penalties)})::DOUBLE AS penalty) GROUP BY 1, 2""")
    view(f"{p}bends", eliminate(f"{p}normal"))
    view(f"{p}bent", f"""
SELECT *, (SELECT sum(sides[i][1 + {horizon} + i]) FROM (SELECT unnest(range(1, {sides + 1})) AS i)) AS used FROM {p}bends""")
    view(f"{p}fourier", f"""
SELECT b.series_id, f.penalty, f.form, b.coef, b.sides, b.used, f.sse, f.months, f.sigma FROM {p}bent b JOIN {stored}fourier f ON f.series_id = b.series_id AND f.penalty = b.form""" if stored else f"""
SELECT *, sqrt(sse / (months - used)) AS sigma FROM (
  SELECT b.series_id, b.form AS penalty, 'trend+3' AS form, b.coef, b.sides, b.used, sum((value - list_dot_product(x, coef)) ** 2) AS sse, count(*) AS months
  FROM {p}design d JOIN {p}bent b ON b.series_id = d.series_id WHERE known GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY sse / (months - used) ** 2, CAST(penalty AS DOUBLE)) = 1""")
    spreads.append(f"""SELECT series_id, 'fourier' AS model, step, sigma * sqrt(1 + list_dot_product(x, list_transform(sides, lambda r: r[step + 1]))) AS spread
        FROM {p}ahead_x JOIN {p}fourier USING (series_id)""")
    fitted.append(f"""SELECT series_id, 'fourier' AS model, date, value AS actual, list_dot_product(x, coef) AS predicted
        FROM {p}design JOIN {p}fourier USING (series_id) WHERE known""")
    ahead.append(f"""SELECT series_id, 'fourier' AS model, step, list_dot_product({design('(n - 1 + step)', 'month(date)')}, coef) AS forecast
        FROM {p}months JOIN {p}fourier USING (series_id)""")
    view(f"{p}season", f"""
SELECT series_id, 'ets' AS model, step, CASE form[3] WHEN 'A' THEN s[(step - 1) % {season} + 1] WHEN 'M' THEN (l + b * step) * (s[(step - 1) % {season} + 1] - 1) ELSE 0 END AS season
FROM {p}path JOIN {p}months USING (series_id) WHERE pos = {p}path.n - 1
UNION ALL SELECT series_id, 'fourier', step, list_dot_product(x[3:8], coef[3:8]) FROM {p}ahead_x JOIN {p}fourier USING (series_id)
UNION ALL SELECT series_id, 'ar', step, NULL FROM {p}ar_ahead""")
    view(f"{p}fitted", " UNION ALL ".join(fitted))
    view(f"{p}ahead", " UNION ALL ".join(ahead))
    view(f"{p}spread", " UNION ALL ".join(spreads))


def accuracy_sql(src):
    return f"""
SELECT *, sqrt(mse) AS rmse FROM (
  SELECT series_id, model, count(*) AS n_points, avg(abs(actual - predicted)) AS mae, avg((actual - predicted) ** 2) AS mse,
         avg(abs(actual - predicted) / nullif(abs(actual), 0)) * 100 AS mape,
         avg(2 * abs(actual - predicted) / nullif(abs(actual) + abs(predicted), 0)) * 100 AS smape,
         CASE WHEN stddev_pop(predicted) > 0 AND stddev_pop(actual) > 0 THEN corr(actual, predicted) ** 2 END AS r_squared
  FROM {src} WHERE actual IS NOT NULL AND predicted IS NOT NULL GROUP BY 1, 2)"""


SCORES = "series_id model n_points:i mae:2 rmse:2 mape:6 smape:6 r_squared:6"
model_views("m_", "sales_series", 18)


def fitted(t, model, settings=SETTINGS, series=None):
    return m.fit_models(m.pack_series(sales(t) if series is None else series), (model,), settings)


def unpack(df, names):
    return df.select("series_id", "form", "aic", F.sqrt(F.col("sse") / 1e6).alias("root_sse"), *[F.col("params")[k].alias(k) for k in names])


WEIGHTS = ("alpha", "beta", "gamma")
query("ets_tournament", "series_id form aic:4 root_sse:2 alpha:6 beta:6 gamma:6", lambda t: unpack(fitted(t, "ets"), WEIGHTS),
      "SELECT *, sqrt(sse / 1e6) AS root_sse FROM m_ets")


def every_form(t):
    fits = [fitted(t, "ets", replace(SETTINGS, ets_forms=(f,))) for f in SETTINGS.ets_forms]
    both = fits[0].unionByName(fits[1]).unionByName(fits[2]).unionByName(fits[3])
    return m.run_models(both, 14).select(
        "series_id", "form", "aic", *[F.col("params")[k].alias(k) for k in WEIGHTS],
        F.posexplode_outer(F.arrays_zip("run.forecast", "run.spread")).alias("k", "z")).select(
        "*", (F.col("k") + 1).alias("step"), "z.forecast", "z.spread")


query("ets_forms", "series_id form aic:4 alpha:6 beta:6 gamma:6 step:i forecast:2 spread:2", every_form,
      """SELECT p.series_id, form, p.n * ln(sse / p.n) + 2 * k AS aic, alpha, beta, gamma, step,
             CASE form[3] WHEN 'A' THEN l + b * step + s[(step - 1) % 12 + 1] WHEN 'M' THEN (l + b * step) * s[(step - 1) % 12 + 1]
                  ELSE l + b * step END AS forecast, """ + """
             sqrt(sse / p.n * (1 + coalesce(list_sum(list_transform(range(1, step), lambda i: (
               alpha * (1 + beta * (step - i)) * CASE WHEN form[3] = 'M' THEN s[(step - 1) % 12 + 1] / s[(i - 1) % 12 + 1] ELSE 1 END
               + CASE WHEN (step - i) % 12 = 0 AND form[3] <> 'N' THEN gamma * CASE WHEN form[3] = 'M' THEN (l + b * step) / (l + b * i) ELSE 1 END ELSE 0 END) ** 2)), 0))) AS spread
         FROM m_form_path p JOIN m_months d ON d.series_id = p.series_id AND step <= 14 WHERE pos = p.n - 1""")
AR_COLUMNS = "series_id form aic:4 root_sse:2 " + " ".join(f"{c}:6" for c in ar.PARAMS)
query("ar_tournament", AR_COLUMNS, lambda t: unpack(fitted(t, "ar"), ar.PARAMS), "SELECT *, sqrt(sse / 1e6) AS root_sse FROM m_ar")
COEF = [f"c{i}" for i in range(8 + SETTINGS.knots)]
query("fourier_trend_forecast", "series_id form aic:4 penalty:4 " + " ".join(f"{c}:2" for c in COEF), lambda t: unpack(fitted(t, "fourier"), [*COEF, "penalty"]),
      "SELECT *, months * ln(sse / months) + 2 * (used + 1) AS aic, " + ", ".join(f"coef[{i + 1}] AS {c}" for i, c in enumerate(COEF)) + " FROM m_fourier")


def bounds_of_all(t):
    run = m.run_models(m.fit_models(m.pack_series(sales(t))), 18)
    return run.select("series_id", "model", F.posexplode_outer("run.spread").alias("k", "spread")).withColumn("step", F.col("k") + 1)


query("forecast_spread", "series_id model step:i spread:2", bounds_of_all, "SELECT * FROM m_spread")
query("fitted_values", "series_id model date:d actual:4 predicted:2", lambda t: fc.fitted_values(fc.tournament(sales(t))),
      "SELECT * FROM m_fitted")
query("model_store", "series_id model step:i date:d forecast:2",
      lambda t: fc.score(sales(t), cut(fc.fitted_parameters(sales(t))), 18),
      "SELECT a.series_id, a.model, a.step, d.date, a.forecast FROM m_ahead a JOIN m_months d USING (series_id, step)")
query("model_forecasts", "series_id model step:i forecast:2",
      lambda t: fc.score(sales(t), fc.fitted_parameters(sales(t)), 18), "SELECT * FROM m_ahead")
query("accuracy", SCORES, lambda t: fc.accuracy(fc.fitted_values(fc.tournament(sales(t)))), accuracy_sql("m_fitted"))
query("select_model", "series_id model mape:6",
      lambda t: fc.select_model(fc.accuracy(fc.fitted_values(fc.tournament(sales(t))))),
      "SELECT series_id, arg_min(model, mape) AS model, min(mape) AS mape FROM accuracy GROUP BY 1")
query("fitted_parameters", "series_id model form aic:4 mape:6 data_end_date:d",
      lambda t: fc.fitted_parameters(sales(t)).withColumn("mape", F.col("scores.mape")),
      """SELECT f.series_id, f.model, form, aic, mape, data_end_date FROM (
           SELECT series_id, 'ets' AS model, form, aic FROM m_ets UNION ALL SELECT series_id, 'ar', form, aic FROM m_ar
           UNION ALL SELECT series_id, 'fourier', form, months * ln(sse / months) + 2 * (used + 1) FROM m_fourier) f
         JOIN accuracy a ON a.series_id = f.series_id AND a.model = f.model
         JOIN (SELECT series_id, max(date) AS data_end_date FROM sales_series GROUP BY 1) e ON e.series_id = f.series_id""")
query("acceptance_gate", "series_id model mape:6 r_squared:6 accepted:b",
      lambda t: fc.acceptance_gate(fc.accuracy(fc.fitted_values(fc.tournament(sales(t))))),
      "SELECT *, coalesce(r_squared >= 0.85 AND mape <= 15, false) AS accepted FROM accuracy")


def horizon_sql(p, choice):
    return f"""
SELECT a.series_id, a.model, a.step, date, forecast, forecast - {Z!r} * spread AS lower_bound,
       forecast + {Z!r} * spread AS upper_bound, 0.95 AS confidence_level
FROM {p}ahead a JOIN {choice} c ON c.series_id = a.series_id AND c.model = a.model
JOIN {p}spread s ON s.series_id = a.series_id AND s.model = a.model AND s.step = a.step
JOIN {p}months d ON d.series_id = a.series_id AND d.step = a.step"""


query("forecast_horizon", "series_id model step:i date:d forecast:2 lower_bound:2 upper_bound:2 confidence_level:2",
      lambda t: fc.forecast_horizon(sales(t)), horizon_sql("m_", "select_model"))
query("forecast_components", "series_id model step:i date:d forecast:2 trend:2 season:2", lambda t: fc.forecast_components(sales(t)),
      """SELECT a.series_id, a.model, a.step, d.date, a.forecast, a.forecast - season AS trend, season FROM m_ahead a
         JOIN select_model c ON c.series_id = a.series_id AND c.model = a.model JOIN m_months d ON d.series_id = a.series_id AND d.step = a.step
         JOIN m_season s ON s.series_id = a.series_id AND s.model = a.model AND s.step = a.step""")
query("forecast_components_quarterly", "series_id model step:i forecast:2 season:2",
      lambda t: m.run_models(m.fit_models(m.pack_series(sales(t)), settings=QUARTERLY), 18, QUARTERLY).select(
          "series_id", "model", F.posexplode_outer(F.arrays_zip("run.forecast", "run.season")).alias("k", "z")).select(
          "series_id", "model", (F.col("k") + 1).alias("step"), "z.forecast", "z.season"),
      "SELECT a.*, season FROM q_ahead a JOIN q_season s ON s.series_id = a.series_id AND s.model = a.model AND s.step = a.step")
query("forecast_growth", "series_id step:i mom_growth:6 yoy_growth:6 cumulative_index:1",
      lambda t: features.forecast_growth(trend_forecast(sales(t))),
      f"""SELECT series_id, step, (forecast / lag(forecast) OVER {W} - 1) * 100 AS mom_growth,
             (forecast / lag(forecast, 12) OVER {W} - 1) * 100 AS yoy_growth,
             forecast / first_value(forecast) OVER {W} * 100 AS cumulative_index FROM trend_forecast""")
query("forecast_kpis",
      "series_id start_value:2 end_value:2 total_growth_pct:6 average_monthly:2 total:2 std:2 cv_pct:6 min_forecast:2 "
      "max_forecast:2 trajectory seasonality volatility",
      lambda t: fc.forecast_kpis(fc.forecast_horizon(sales(t))),
      """SELECT *, (end_value / start_value - 1) * 100 AS total_growth_pct, std / average_monthly * 100 AS cv_pct,
           CASE WHEN end_value > seventh * 1.05 THEN 'Accelerating' WHEN end_value > seventh * 0.95 THEN 'Stable' ELSE 'Declining' END AS trajectory,
           CASE WHEN (max_forecast - min_forecast) / average_monthly > 0.1 THEN 'Detected' ELSE 'Minimal' END AS seasonality,
           CASE WHEN std / average_monthly > 0.15 THEN 'High Volatility' WHEN std / average_monthly > 0.08 THEN 'Moderate Volatility'
                ELSE 'Low Volatility' END AS volatility
         FROM (SELECT series_id, arg_min(forecast, step) AS start_value, arg_max(forecast, step) AS end_value,
                      avg(forecast) AS average_monthly, sum(forecast) AS total, stddev_samp(forecast) AS std,
                      min(forecast) AS min_forecast, max(forecast) AS max_forecast, max(forecast) FILTER (step = 7) AS seventh
               FROM forecast_horizon GROUP BY 1)""")

# Hold-out: the same views over the series without its last six months.
view("sales_cut", f"""
SELECT series_id, date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back
FROM sales_series) WHERE back > 6""")
view("sales_held", """
SELECT series_id, 7 - back AS step, value AS actual FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back
FROM sales_series) WHERE back <= 6""")
model_views("h_", "sales_cut", 6)
view("held_points", """
SELECT a.series_id, model, actual, forecast AS predicted FROM h_ahead a
JOIN sales_held h ON h.series_id = a.series_id AND h.step = a.step""")
query("holdout_validation", SCORES, lambda t: fc.holdout_validation(sales(t)), accuracy_sql("held_points"))

# Going on from stored states: the last six months are folded in, against a replay of the whole history with the stored parameters.
model_views("i_", "sales_series", 18, stored="h_")


def incremental(t):
    held = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("date"))) > 6
    early = cut(sales(t).withColumn("early", held)).where("early").drop("early")
    states = cut(fc.model_states(early, fc.fitted_parameters(early)))
    return fc.advance_states(states, sales(t), 18)[1]


query("score_incremental", "series_id model step:i date:d forecast:2 spread:2", incremental,
      """SELECT a.series_id, a.model, a.step, d.date, a.forecast, s.spread FROM i_ahead a
         JOIN i_months d ON d.series_id = a.series_id AND d.step = a.step JOIN i_spread s ON s.series_id = a.series_id AND s.model = a.model AND s.step = a.step""")

# Backtest: the same views, every origin's window being a series of its own.
view("bt_rows", f"SELECT *, {POSITION} AS i FROM m_pos")
view("bt_windows", """
SELECT o.series_id || '@' || o.date AS series_id, v.date, v.value
FROM bt_rows o JOIN bt_rows v ON v.series_id = o.series_id AND v.i BETWEEN o.i - 36 AND o.i - 1 WHERE o.i > 36 AND o.known""")
model_views("b_", "bt_windows", 1)
view("bt_points", """
SELECT o.series_id, o.date, f.model, o.value AS actual, forecast AS predicted
FROM b_ahead f JOIN bt_rows o ON o.series_id || '@' || o.date = f.series_id""")
query("rolling_backtest_points", "series_id date:d model actual:4 predicted:2",
      lambda t: fc.rolling_backtest_points(sales(t)), "SELECT * FROM bt_points")
query("rolling_backtest", SCORES, lambda t: fc.rolling_backtest(sales(t)), accuracy_sql("bt_points"))


# Gaps: missing months, months without a value, and none known at the end.
def gappy(t):
    once = dedup_first(t.dirty, "dup_no")
    return once.select("series_id", "date", F.col(SALES).alias("value"))


def trailing(t):
    return sales(t).withColumn("value", F.when(F.col("date") < F.lit("2001-08-01").cast("date"), F.col("value")))


view("gappy_series", "SELECT series_id, date, sales_total_try AS value FROM dedup_first")
view("trailing_series", "SELECT series_id, date, CASE WHEN date < DATE '2001-08-01' THEN value END AS value FROM sales_series")
HORIZON = "series_id model step:i date:d forecast:2 lower_bound:2 upper_bound:2 confidence_level:2"
for prefix, source, frame, name in (("g_", "gappy_series", gappy, "gaps"), ("t_", "trailing_series", trailing, "trailing_nulls")):
    model_views(prefix, source, 18)
    view(f"{prefix}accuracy", accuracy_sql(f"{prefix}fitted"))
    view(f"{prefix}choice", f"SELECT series_id, arg_min(model, mape) AS model FROM {prefix}accuracy GROUP BY 1")
    query(f"forecast_horizon_{name}", HORIZON, lambda t, frame=frame: fc.forecast_horizon(frame(t)), horizon_sql(prefix, f"{prefix}choice"))

# Unknown months are integrated out of the likelihood.
query("ar_tournament_gaps", AR_COLUMNS, lambda t: unpack(fitted(t, "ar", series=gappy(t)), ar.PARAMS), "SELECT *, sqrt(sse / 1e6) AS root_sse FROM g_ar")

QUARTERLY = replace(SETTINGS, season=4)
model_views("q_", "sales_series", 18, season=4)
query("ets_tournament_quarterly", "series_id form aic:4 root_sse:2 alpha:6 beta:6 gamma:6",
      lambda t: unpack(fitted(t, "ets", QUARTERLY), WEIGHTS),
      "SELECT *, sqrt(sse / 1e6) AS root_sse FROM q_ets")
query("model_forecasts_quarterly", "series_id model step:i forecast:2",
      lambda t: fc.score(sales(t), fc.fitted_parameters(sales(t), settings=QUARTERLY), 18, QUARTERLY), "SELECT * FROM q_ahead")

# Short series: every model of every series has a row, with the reason where it has no figures.
view("short_series", "SELECT series_id, date, value FROM sales_series WHERE date < DATE '1996-01-01' + to_months(CAST(ascii(series_id) % 3 AS INT) * 10)")
model_views("s_", "short_series", 18)


def short(t):
    months = F.ascii("series_id") % 3 * 10
    return sales(t).where(F.col("date") < F.add_months(F.lit("1996-01-01").cast("date"), months))


query("fitted_parameters_short", "series_id model form aic:4 reason",
      lambda t: fc.fitted_parameters(short(t)),
      """SELECT k.series_id, k.model, f.form, f.aic, CASE WHEN f.form IS NULL THEN 'too short' END AS reason
         FROM (SELECT DISTINCT series_id, unnest(['ar', 'ets', 'fourier']) AS model FROM short_series) k LEFT JOIN (
           SELECT series_id, 'ets' AS model, form, aic FROM s_ets UNION ALL SELECT series_id, 'ar', form, aic FROM s_ar
           UNION ALL SELECT series_id, 'fourier', form, months * ln(sse / months) + 2 * (used + 1) FROM s_fourier) f ON f.series_id = k.series_id AND f.model = k.model""")
