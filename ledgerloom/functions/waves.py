"""A line that may bend, with yearly waves, fitted to many series at once.

Least squares over the known months; the slope may change at evenly spaced knots in the first four fifths of the series, and the squares of those
changes are penalised, so that a straight series stays straight. Of several penalties each series takes the one of least generalised
cross-validation: the squared error against the square of the months that the fit leaves free.
"""

from __future__ import annotations

import numpy as np

from ledgerloom.functions.padded import Padded, solved


def size(pairs: int) -> int:
    """Coefficients that are not penalised."""
    return 2 + 2 * pairs


def design(share: np.ndarray, month: np.ndarray, pairs: int, knots: int) -> np.ndarray:
    """Constant, elapsed share of the series, sine and cosine pairs of the calendar month (0 to 11), and the share since each knot."""
    angle = month * (2 * np.pi / 12)
    bends = [np.maximum(share - 0.8 * k / (knots + 1), 0) for k in range(1, knots + 1)]
    return np.stack([np.ones_like(share), share, *[f(k * angle) for k in range(1, pairs + 1) for f in (np.sin, np.cos)], *bends], -1)


def _placed(p: Padded, months: np.ndarray, pairs: int, knots: int):
    t = np.arange(p.y.shape[1])
    return design(t / np.maximum(months, 1)[:, None], (p.first[:, None] + t) % 12, pairs, knots)


def _normal(p: Padded, months: np.ndarray, pairs: int, knots: int):
    """Design, its cross products over the known ones of the first `months`, and which coefficients are penalised."""
    x = _placed(p, months, pairs, knots)
    learnt = p.known & (np.arange(p.y.shape[1]) < months[:, None])
    return x, np.einsum("rti,rtj->rij", x * learnt[..., None], x), np.diag(np.repeat([0.0, 1.0], [size(pairs), knots]))


def fit(p: Padded, pairs: int, knots: int, penalties: tuple[float, ...]):
    """Coefficients, penalty, squared error over the known months, how many there are, and to how many free coefficients the fit amounts."""
    x, plain, bent = _normal(p, p.n, pairs, knots)
    y = np.where(p.known, p.y, 0)
    n, best = p.known.sum(1), None
    for penalty in penalties:
        a = plain + penalty * bent
        coef = solved(a, np.einsum("rti,rt->ri", x, y))
        used = sum(solved(a, plain[..., i])[:, i] for i in range(a.shape[-1]))
        miss = (y - np.einsum("rti,ri->rt", x, coef)) * p.known
        sse = (miss * miss).sum(1)
        made = [coef, np.full(len(n), penalty), sse, used, sse / (n - used) ** 2]
        if best is None:
            best = made
        better = made[-1] < best[-1]
        best = [np.where(better.reshape(-1, *[1] * (new.ndim - 1)), new, old) for new, old in zip(made, best)]
    coef, penalty, sse, used, _ = best
    return coef, penalty, sse, n, used


def run(p: Padded, coef: np.ndarray, penalty: np.ndarray, sigma: np.ndarray, months: np.ndarray, pairs: int, knots: int, horizon: int,
        state: np.ndarray | None = None):
    """Fitted values, forecasts, the standard deviation of each forecast's error (that of a month and that of the coefficients), the end state, and
    the waves' part of each forecast.

    `months` is the length of the series that the coefficients were fitted to: shares and cross products are of those. A state holds the months
    so far, the first one's calendar month, and the cross products.
    """
    if state is None:
        x, plain, bent = _normal(p, months, pairs, knots)
        n, first, next_month = p.n, p.first, p.ahead
    else:
        k = np.arange(p.y.shape[1])
        so_far, first = state[:, 0], state[:, 1]
        x = design((so_far[:, None] + k) / months[:, None], (first[:, None] + so_far[:, None] + k) % 12, pairs, knots)
        _, _, bent = _normal(p.pick(np.arange(0)), np.arange(0), pairs, knots)
        n, plain = so_far + p.n, state[:, 2:].reshape(len(state), *bent.shape)
        next_month = np.where(p.n > 0, p.ahead, first + so_far)
    a = plain + penalty[:, None, None] * bent
    k = np.arange(horizon)
    ahead = design((n[:, None] + k) / np.maximum(months, 1)[:, None], (next_month[:, None] + k) % 12, pairs, knots)
    reach = np.stack([solved(a, ahead[:, h]) for h in range(horizon)], 1)
    unsure = np.einsum("rhi,rhi->rh", reach, ahead)
    after = np.concatenate([n[:, None], first[:, None], plain.reshape(len(plain), -1)], 1)
    return np.einsum("rti,ri->rt", x, coef), np.einsum("rhi,ri->rh", ahead, coef), sigma[:, None] * np.sqrt(1 + unsure), after, np.einsum(
        "rhi,ri->rh", ahead[..., 2 : size(pairs)], coef[:, 2 : size(pairs)])
