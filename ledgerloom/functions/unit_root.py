"""Augmented Dickey-Fuller test with a constant, for several series of one length at once.

The change of a month is regressed on the value before it and on the changes of earlier months; the statistic is the t-ratio of the former. How many
earlier changes are taken is decided by AIC. All regressions tried share their rows, so one matrix of sums holds the normal equations of each as a
leading block.
"""

from __future__ import annotations

import math

import numpy as np

from ledgerloom.functions.padded import solved

#: Response surfaces of MacKinnon (2010) for one series and a constant; powers of 1 / n.
CRITICAL = {"1pct": (-3.43035, -6.5393, -16.786, -79.433), "5pct": (-2.86154, -2.8903, -4.234, -40.04), "10pct": (-2.56677, -1.5384, -2.809, 0.0)}
#: MacKinnon (1994), the normal quantile of the p-value as a polynomial of the statistic, below and above the turn, and where it is 0 or 1.
LOWER, UPPER, TURN, NONE, ALL = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368), -1.61, -18.83, 2.74


def most_lags(n: int) -> int:
    """12 (n / 100)^(1/4), rounded up, but no more than the values allow; negative where there are too few."""
    return min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)


def p_value(statistic: float) -> float:
    if statistic > ALL or statistic < NONE:
        return float(statistic > ALL)
    x = sum(c * statistic**k for k, c in enumerate(LOWER if statistic <= TURN else UPPER))
    return 0.5 * math.erfc(-x / math.sqrt(2))


def critical(level: str, n: int) -> float:
    return sum(c / n**k for k, c in enumerate(CRITICAL[level]))


def _columns(y: np.ndarray, change: np.ndarray, lags: int, lost: int) -> np.ndarray:
    """Constant, value before, earlier changes, and at last the change itself, for all months but the first `lost` changes."""
    rows = change.shape[1] - lost
    return np.stack([np.ones((len(y), rows)), y[:, lost : lost + rows], *[change[:, lost - k : lost - k + rows] for k in range(1, lags + 1)], change[:, lost:]], -1)


def _fit(sums: np.ndarray, size: int):
    """Coefficients and squared error of the leading `size` columns."""
    coef = solved(sums[:, :size, :size], sums[:, :size, -1])
    return coef, sums[:, -1, -1] - (coef * sums[:, :size, -1]).sum(1)


def dickey_fuller(y: np.ndarray):
    """(months in the regression, earlier changes taken, statistic) of every row; NaN where the changes leave no error to compare with."""
    n, most = y.shape[1], most_lags(y.shape[1])
    if most < 0 or not len(y):
        return np.zeros(len(y), int), np.zeros(len(y), int), np.full(len(y), np.nan)
    y = y - y.mean(1, keepdims=True)  # changes nothing but the rounding
    change = np.diff(y)
    x = _columns(y, change, most, most)
    sums, rows = np.einsum("rti,rtj->rij", x, x), n - 1 - most
    with np.errstate(all="ignore"):
        aic = np.stack([rows * np.log(np.maximum(_fit(sums, k + 2)[1] / rows, 1e-300)) + 2 * (k + 2) for k in range(most + 1)], 1)
        lags = np.where(np.isnan(aic), np.inf, aic).argmin(1)
        statistic, months = np.full(len(y), np.nan), n - 1 - lags
        for k in np.unique(lags):
            some = np.flatnonzero(lags == k)
            x = _columns(y[some], change[some], k, k)
            sums = np.einsum("rti,rtj->rij", x, x)
            coef, sse = _fit(sums, k + 2)
            unit = np.zeros((len(some), k + 2))
            unit[:, 1] = 1
            spread = solved(sums[:, :-1, :-1], unit)[:, 1]
            free = n - 1 - k - (k + 2)
            plain = (free > 0) & (sse > 1e-12 * sums[:, -1, -1]) & (np.ptp(y[some], axis=1) > 0)
            statistic[some] = np.where(plain, coef[:, 1] / np.sqrt(sse / max(free, 1) * spread), np.nan)
    return months, lags, statistic
