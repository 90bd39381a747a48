"""Pieces of SQL that several oracle views share."""

W = "(PARTITION BY series_id ORDER BY date)"
WB = "(PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
WA = "(PARTITION BY series_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
WALL = "(PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
WS = "(PARTITION BY series_id)"
MEASURES = ("sales_total_try", "opex_try", "usdtry")


def near(back, ahead):
    return f"(PARTITION BY series_id ORDER BY date ROWS BETWEEN {back} PRECEDING AND {ahead} FOLLOWING)"


def clip(c, low, high):
    return f"(CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END)"


def fill(src, columns):
    parts = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER {WB}, first_value({c} IGNORE NULLS) OVER {WA}) AS {c}"
        for c in columns
    )
    return f"SELECT * REPLACE ({parts}) FROM {src}"


POSITION = "row_number() OVER (PARTITION BY series_id ORDER BY date)"
DAYS = "(date - DATE '1970-01-01')"


def interpolate(src, col, axis, part="series_id", both_ends=False):
    wb = f"(PARTITION BY {part} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wa = f"(PARTITION BY {part} ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    end = ", v1" if both_ends else ""
    return f"""
SELECT * EXCLUDE (x, xk, v0, x0, v1, x1)
       REPLACE (coalesce({col}, v0 + (v1 - v0) * ((x - x0) / nullif(x1 - x0, 0)), v0{end}) AS {col})
FROM (SELECT *, last_value({col} IGNORE NULLS) OVER {wb} AS v0, last_value(xk IGNORE NULLS) OVER {wb} AS x0,
             first_value({col} IGNORE NULLS) OVER {wa} AS v1, first_value(xk IGNORE NULLS) OVER {wa} AS x1
      FROM (SELECT *, CASE WHEN {col} IS NOT NULL THEN x END AS xk
            FROM (SELECT *, CAST({axis} AS DOUBLE) AS x FROM {src})))"""


def smooth(src, col):
    return f"""
SELECT * REPLACE (avg({col}) OVER {near(1, 1)} AS {col})
FROM (SELECT * REPLACE (quantile_cont({col}, 0.5) OVER {near(3, 3)} AS {col}) FROM {src})"""


def normal(seed, series, sim, period, stream):
    """The standard normal draw addressed by (seed, series, sim, period, stream)."""
    digest = f"md5(concat_ws('|', '{seed}', {series}, CAST({sim} AS VARCHAR), CAST({period} AS VARCHAR), '{stream}'))"

    def uniform(start):
        return f"((('0x' || substr({digest}, {start}, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)"

    return f"(sqrt(-2.0 * ln({uniform(1)})) * cos(2.0 * pi() * {uniform(9)}))"


def eliminate(src, ridge=1e-12):
    """Solve systems given as lists of rows, one per (series_id, form), with any number of right-hand sides: `m` becomes them, `logdet` the
    logarithm of the determinant."""
    firm = f"""list_transform(m, lambda r, i: list_transform(r, lambda v, j: v + CASE WHEN i = j
      THEN {ridge!r}::DOUBLE * list_sum(list_transform(range(1, len(m) + 1), lambda k: m[k][k])) ELSE 0 END))"""
    return f"""
WITH RECURSIVE g AS (
  SELECT series_id, form, 1 AS k, {firm if ridge else 'm'} AS m, 0.0::DOUBLE AS logdet FROM {src}
  UNION ALL
  SELECT series_id, form, k + 1, list_transform(range(1, len(m) + 1), lambda i: CASE WHEN i = k
      THEN list_transform(m[k], lambda v: v / m[k][k])
      ELSE list_transform(range(1, len(m[1]) + 1), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END), logdet + ln(m[k][k])
  FROM g WHERE k <= len(m))
SELECT series_id, form, list_transform(m, lambda r: r[len(m) + 1]) AS coef, list_transform(m, lambda r: r[len(m) + 1:]) AS sides, logdet FROM g WHERE k = len(m) + 1"""
