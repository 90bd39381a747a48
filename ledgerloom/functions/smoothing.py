"""Exponential smoothing of many series with many settings at once.

Trend and season are additive (A), multiplicative (M) or none (N), the error is additive: forms are written error, trend, season.
"""

from __future__ import annotations

import itertools

import numpy as np

from ledgerloom.functions.padded import Padded

FORMS = ("AAA", "AAM", "ANA", "ANN")
STEPS = (0.1, 0.05, 0.025, 0.0125)  # of the search that starts from the best setting of the grid
LEAST, MOST = 0.001, 0.999


def size(form: str, season: int) -> int:
    """Smoothing weights and start values."""
    return 2 + 2 * (form[1] != "N") + (1 + season) * (form[2] != "N")


def usable(p: Padded, form: str, season: int) -> np.ndarray:
    if form[2] == "N":
        return p.n >= 2
    positive = np.where(np.isnan(p.y), 1, p.y).min(1, initial=1) > 0
    return (p.n >= 2 * season) & (positive | (form[2] != "M"))


def start(p: Padded, form: str, season: int):
    """Level, slope and season before the first value, from the first two seasons.

    The first season's mean stands for its middle; the slope leads from there back to the month before the first, and is taken
    out of the seasonal values.
    """
    first = p.y[:, :season]
    middle = np.nanmean(first, 1) if first.size else np.zeros(len(p.y))
    slope = (p.y[:, season : 2 * season].mean(1) - middle) / season if form[1] == "A" else np.zeros(len(p.y))
    level = middle - slope * (season + 1) / 2
    if form[2] == "N":
        return level, slope, np.zeros((len(p.y), 0))
    line = level[:, None] + slope[:, None] * np.arange(1, season + 1)
    return level, slope, first - line if form[2] == "A" else first / line


def smooth(p: Padded, form: str, season: int, weights: np.ndarray, state=None, path: bool = False):
    """Squared errors, end state (level, slope, season beginning with the next month's), and with `path` what was expected of each month.

    `weights` are alpha, beta, gamma by series and setting. The season turns in place: month t has position t modulo its length.
    """
    level, slope, wave = (np.repeat(x[:, None], weights.shape[1], 1) for x in (state or start(p, form, season)))
    wave = np.moveaxis(wave, -1, 0).copy()
    a, b, g = np.moveaxis(weights, -1, 0)
    ab, sse = a * b, np.zeros(a.shape)
    seen = np.full((*a.shape, p.y.shape[1]), np.nan) if path else None
    with np.errstate(all="ignore"):
        for t, m in enumerate(p.alive()):
            v = p.y[:m, t, None]
            base = level[:m] + slope[:m]
            if form[2] == "N":
                expected = base
                error = v - base
            else:
                old = wave[t % season, :m]
                if form[2] == "A":
                    expected = base + old
                    error = v - base - old
                    new = old + g[:m] * error
                else:
                    expected = base * old
                    error = v / old - base
                    new = old + g[:m] * (v / base - old)
                wave[t % season, :m] = new
            miss = v - expected
            sse[:m] += miss * miss
            level[:m] = base + a[:m] * error
            if form[1] == "A":
                slope[:m] += ab[:m] * error
            if path:
                seen[:m, :, t] = expected
    if form[2] != "N":
        turn = (p.n[:, None] + np.arange(season)) % season
        wave = np.take_along_axis(np.moveaxis(wave, 0, -1), np.repeat(turn[:, None], a.shape[1], 1), 2)
    else:
        wave = np.zeros((*a.shape, 0))
    return sse, (level, slope, wave), seen


def _settings(form: str, alphas, betas, gammas) -> np.ndarray:
    return np.array(list(itertools.product(alphas, betas if form[1] == "A" else (0.0,), gammas if form[2] != "N" else (0.0,))))


def fit(p: Padded, form: str, season: int, grid: tuple[float, ...]):
    """The best weights of each series and their squared error: the grid's best, then the best neighbour at smaller and smaller steps.

    Equal errors: the smaller alpha, beta, gamma. The error is never above the grid's.
    """
    every = np.arange(len(p.y))
    weights = np.repeat(_settings(form, grid, grid, grid)[None], len(p.y), 0)
    for step in (*STEPS, None):
        sse, _, _ = smooth(p, form, season, weights)
        sse = np.where(np.isfinite(sse), sse, np.inf)
        best = sse.argmin(1)
        won, error = weights[every, best], sse[every, best]
        if step is not None:
            moves = _settings(form, *[(-step, 0.0, step)] * 3)
            in_use = np.array([True, form[1] == "A", form[2] != "N"])
            weights = np.where(in_use, np.clip(won[:, None] + moves, LEAST, MOST), 0.0)
    return won, error


def ahead(form: str, season: int, state, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts from end states without the axis of settings, and the part of each that is the season's."""
    level, slope, wave = state
    k = np.arange(1, horizon + 1)
    line = level[:, None] + slope[:, None] * k
    if form[2] == "N":
        return line, np.zeros_like(line)
    turned = wave[:, (k - 1) % season]
    part = turned if form[2] == "A" else line * turned - line
    return line + part, part


def spread(form: str, season: int, state, weights: np.ndarray, sigma: np.ndarray, horizon: int) -> np.ndarray:
    """Standard deviation of each forecast's error.

    An error of one month reaches the forecast j months on by alpha (1 + beta j) through level and slope, and by gamma through the season after
    whole seasons. Additive forms are linear, so the squares add up exactly; the multiplicative season is taken to first order about the
    forecast path.
    """
    level, slope, wave = state
    a, b, g = weights.T
    k = np.arange(1, horizon + 1)
    line = level[:, None] + slope[:, None] * k
    turned = wave[:, (k - 1) % season] if form[2] == "M" else np.ones((len(level), horizon))
    total = np.ones((len(level), horizon))
    with np.errstate(all="ignore"):
        for h in range(1, horizon):  # forecast h + 1, errors of the months before it
            j = h - np.arange(h)
            reach = (a[:, None] * (1 + (b[:, None] * j if form[1] == "A" else 0))) * turned[:, h, None] / turned[:, :h]
            if form[2] != "N":
                seasonal = (j % season == 0) * g[:, None]
                reach = reach + (seasonal * line[:, h, None] / line[:, :h] if form[2] == "M" else seasonal)
            total[:, h] += (reach * reach).sum(1)
    return sigma[:, None] * np.sqrt(total)
