"""Seasonal autoregression with moving averages on the twice differenced series, for many series at once.

With w the month-on-month change of the change over a season, (1 - phi1 B - phi2 B^2)(1 - sphi B^s) w = (1 + theta1 B + theta2 B^2)(1 + stheta B^s) e.
The likelihood is that of the known months given no change and no error before the first w. Errors and months correspond one
to one, with determinant one. So unknown months are integrated out exactly: the errors are linear in the unknown values, whose least-squares
values are those that a filter skipping them would expect, and the determinant of their normal equations enters the likelihood.
"""

from __future__ import annotations

import numpy as np

from ledgerloom.functions.padded import Padded, lagged, solved

PARAMS = ("phi1", "phi2", "theta1", "theta2", "sphi", "stheta")
#: The orders that are tried, as autoregressive and moving-average terms of months and of seasons; all differenced once each way.
ORDERS = {"(1,1,1)(1,1,1)": (1, 1, 1, 1), "(2,1,2)(1,1,1)": (2, 2, 1, 1), "(1,1,0)(0,1,1)": (1, 0, 0, 1), "(0,1,1)(1,1,0)": (0, 1, 1, 0)}
#: Coefficients are kept this far inside the region where forecasts and errors stay bounded.
EDGE = 0.98


def least(season: int) -> int:
    """The shortest series that is fitted."""
    return 2 * season + 9


def differenced(y: np.ndarray, season: int) -> np.ndarray:
    """w, along the last axis."""
    change = y[..., season:] - y[..., :-season]
    return change[..., 1:] - change[..., :-1]


def _inside(p: Padded, season: int) -> np.ndarray:
    return np.arange(p.y.shape[1] - season - 1) < (p.n - season - 1)[:, None]


def _kept_inside(one, two):
    two = np.clip(two, -EDGE, EDGE)
    return np.clip(one, -EDGE * (1 - two), EDGE * (1 - two)), two


def estimate(w: np.ndarray, inside: np.ndarray, order: tuple[int, int, int, int], season: int) -> np.ndarray:
    """`PARAMS` of each row of w (zero where it is not `inside` the series) in two steps of least squares: a long autoregression for the errors,
    then w on its own lags and those of the errors. What lies before the first w counts as zero."""
    def regressed(columns):
        x = np.stack(columns, -1)
        coef = solved(np.einsum("rti,rtj->rij", x, x), np.einsum("rti,rt->ri", x, w))
        return coef, w - np.einsum("rti,ri->rt", x, coef)

    _, e = regressed([lagged(w, k) * inside for k in (1, 2, 3, season, season + 1)])
    p, q, sp, sq = order
    lags = [*range(1, p + 1), *[season] * sp], [*range(1, q + 1), *[season] * sq]
    coef, _ = regressed([lagged(w, k) * inside for k in lags[0]] + [lagged(e, k) * inside for k in lags[1]])
    out = np.zeros((len(w), 6))
    out[:, :p] = coef[:, :p]
    out[:, 4 : 4 + sp] = coef[:, p : p + sp]
    out[:, 2 : 2 + q] = coef[:, p + sp : p + sp + q]
    out[:, 5 : 5 + sq] = coef[:, p + sp + q :]
    out[:, 0], out[:, 1] = _kept_inside(out[:, 0], out[:, 1])
    minus_one, minus_two = _kept_inside(-out[:, 2], -out[:, 3])
    out[:, 2], out[:, 3] = -minus_one, -minus_two
    out[:, 4:] = np.clip(out[:, 4:], -EDGE, EDGE)
    return out


def _lags(params: np.ndarray, season: int):
    """(lag, coefficient of w, coefficient of e) of the multiplied polynomials."""
    p1, p2, t1, t2, sp, sq = np.moveaxis(params, -1, 0)
    return [(1, p1, t1), (2, p2, t2), (season, sp, sq), (season + 1, -p1 * sp, t1 * sq), (season + 2, -p2 * sp, t2 * sq)]


def errors(w: np.ndarray, params: np.ndarray, season: int, before: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """e of w (series, channel, month); both are linear, so every channel is filtered by itself. `before` are the w and e of the season and two months
    before, zero where it is not given."""
    lags, back = _lags(params, season), season + 2
    w_before, e_before = before or (np.zeros((*w.shape[:2], back)),) * 2
    w = np.concatenate([w_before, w], 2)
    own = w - sum(a[:, None, None] * lagged(w, k) for k, a, _ in lags)
    e = np.concatenate([e_before, np.zeros((*w.shape[:2], w.shape[2] - back))], 2)
    for t in range(back, w.shape[2]):
        e[..., t] = own[..., t] - sum(c[:, None] * e[..., t - k] for k, _, c in lags)
    return e[..., back:]


def _parted(state: np.ndarray, season: int):
    """The last w, e and y that a state holds."""
    return np.split(state, [season + 2, 2 * season + 4], 1)


def innovations(p: Padded, params: np.ndarray, season: int, state: np.ndarray | None = None):
    """Errors, the series with its unknown months filled, squared error, how many months count, and the logarithm of the determinant.

    With a `state` the series follow on from it: all their months have an error, and the filled series begins with the state's values.
    """
    unknown = ~p.known & ~np.isnan(p.y)
    most = int(unknown.sum(1).max(initial=0))
    channels = np.zeros((len(p.y), 1 + most, p.y.shape[1]))
    channels[:, 0] = np.where(np.isnan(p.y), 0, p.y)
    row, month = np.nonzero(unknown)
    channels[row, 1 + np.arange(len(row)) - np.searchsorted(row, row), month] = 1
    if state is None:
        before, inside, count = None, _inside(p, season), np.maximum(p.n - season - 1, 0)
    else:
        w, e, y = (np.concatenate([x[:, None], np.zeros((len(x), most, x.shape[1]))], 1) for x in _parted(state, season))
        before, inside, count = (w, e), np.arange(p.y.shape[1]) < p.n[:, None], p.n
        channels = np.concatenate([y, channels], 2)
    e = errors(differenced(channels, season) * inside[:, None], params, season, before) * inside[:, None]
    free = np.arange(most) < unknown.sum(1)[:, None]
    d = e[:, 1:]
    normal = np.einsum("rit,rjt->rij", d, d) + np.eye(most) * ~free[:, None]
    fill = -np.linalg.solve(normal, np.einsum("rit,rt->ri", d, e[:, 0])[..., None])[..., 0] * free if most else np.zeros((len(p.y), 0))
    whole = channels[:, 0] + np.einsum("ri,rit->rt", fill, channels[:, 1:])
    e = e[:, 0] + np.einsum("ri,rit->rt", fill, d)
    return e, whole, (e * e).sum(1), count - unknown.sum(1), np.linalg.slogdet(normal)[1] if most else np.zeros(len(p.y))


def fit(p: Padded, order: tuple[int, int, int, int], season: int):
    """Params, squared error, AIC (NaN where the months known do not settle the fit) and the spread of the errors."""
    w = np.nan_to_num(differenced(p.y, season))
    params = estimate(w, _inside(p, season), order, season)
    _, _, sse, count, logdet = innovations(p, params, season)
    with np.errstate(all="ignore"):
        aic = count * np.log(np.maximum(sse / count, 1e-300)) + logdet + 2 * (sum(order) + 1)
        return params, sse, np.where(count > sum(order) + 1, aic, np.nan), np.sqrt(sse / count)


def _continued(w, e, y, params, season, horizon):
    """y carried on from the last months of w, e (series, month) and y; errors to come are zero."""
    lags, out = _lags(params, season), []
    w, e, y = (list(x.T) for x in (w, e, y))
    for _ in range(horizon):
        new = sum(a * w[-k] + c * e[-k] for k, a, c in lags)
        y.append(new + y[-1] + y[-season] - y[-season - 1])
        w.append(new)
        e.append(np.zeros_like(new))
    return np.stack(y[-horizon:], 1)


def run(p: Padded, params: np.ndarray, sigma: np.ndarray, season: int, horizon: int, state: np.ndarray | None = None):
    """Fitted values (NaN for a season and a month, unless they follow on from a state), forecasts, the standard deviation of each
    forecast's error, the end state, and the season's part, which this model does not tell apart (NaN).

    The deviation is that of the errors to come, through the weights with which each reaches later months. An unknown month of a state keeps the value
    it had then; seen from later months on it would be a little different.
    """
    e, whole, *_ = innovations(p, params, season, state)
    back, lost = season + 2, season + 1
    fitted = np.full(p.y.shape, np.nan)
    fitted[:, 0 if state is not None else lost :] = whole[:, lost:] - e
    w = differenced(whole, season)
    months, values = p.n - lost, p.n
    if state is not None:
        before = _parted(state, season)
        w, e = np.concatenate([before[0], w], 1), np.concatenate([before[1], e], 1)
        months, values = p.n + back, p.n + lost

    def last(x, n, size):
        """The `size` months of each series up to its n-th, zeros where it is shorter."""
        at = n[:, None] - np.arange(size, 0, -1)
        return np.where(at >= 0, np.take_along_axis(x, np.maximum(at, 0), 1), 0)

    ends = [last(w, months, back), last(e, months, back), last(whole, values, lost)]
    out = _continued(*ends, params, season, horizon)
    hit = np.zeros((len(params), back))
    hit[:, -1] = 1
    weights = np.ones((len(params), horizon))
    # An error of one moves w and y by one in its own month.
    weights[:, 1:] = _continued(hit, hit, hit[:, -lost:], params, season, horizon)[:, : horizon - 1]
    return fitted, out, sigma[:, None] * np.sqrt(np.cumsum(weights**2, 1)), np.concatenate(ends, 1), np.full(out.shape, np.nan)
