"""Packed series of an Arrow batch side by side: one matrix row a series, so that a model steps through the months of all of them at once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

ROWS = 512  # series worked on at once: bounds the memory of a task whatever its batches hold


class Padded(NamedTuple):
    rows: np.ndarray  # places in the batch, longest series first
    y: np.ndarray  # series, month; NaN from a series' end on
    known: np.ndarray  # whether a month's value was seen, and not put on the line between its neighbours
    n: np.ndarray  # months
    first: np.ndarray  # calendar month (0 to 11) of the first value
    ahead: np.ndarray  # calendar month of the first forecast

    def pick(self, some: np.ndarray) -> Padded:
        """The series at these places of this one, in order; cut to the longest."""
        n = self.n[some]
        width = int(n.max(initial=0))
        return Padded(self.rows[some], self.y[some, :width], self.known[some, :width], n, self.first[some], self.ahead[some])

    def alive(self) -> np.ndarray:
        """For each month how many of the series reach it."""
        return np.searchsorted(-self.n, -np.arange(self.y.shape[1]))


def _filled(column: pa.Array, width: int, empty, kind) -> np.ndarray:
    out = np.full((len(column), width), empty, kind)
    sizes = np.diff(column.offsets.to_numpy())
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(column)), sizes), place] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def padded(batch: pa.RecordBatch) -> Iterator[Padded]:
    """The series of a batch with the columns of `models.pack_series`, up to `ROWS` at a time."""
    if not batch.num_rows:
        return
    sizes = np.diff(batch["y"].offsets.to_numpy())
    order = np.argsort(-sizes, kind="stable")
    for lo in range(0, len(order), ROWS):
        rows = order[lo : lo + ROWS]
        part = batch.select(["dates", "y", "known"]).take(pa.array(rows))
        n, width = sizes[rows], int(sizes[rows[0]])
        days = part["dates"].flatten().to_numpy(zero_copy_only=False).astype("datetime64[D]")
        begin = np.cumsum(n) - n
        some = np.flatnonzero(n)
        first, ahead = np.zeros(len(rows), int), np.zeros(len(rows), int)
        first[some] = days[begin[some]].astype("datetime64[M]").astype(int) % 12
        last = days[begin[some] + n[some] - 1]
        months = last.astype("datetime64[M]")
        ahead[some] = (months.astype(int) + 1 + (last != months.astype("datetime64[D]"))) % 12
        yield Padded(rows, _filled(part["y"], width, np.nan, float), _filled(part["known"], width, False, bool), n, first, ahead)


def lagged(x: np.ndarray, lag: int) -> np.ndarray:
    """`x` moved by `lag` places along its last axis, zeros before."""
    out = np.zeros_like(x)
    out[..., lag:] = x[..., : x.shape[-1] - lag]
    return out


def solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solutions of many small symmetric systems; zero where all is zero, NaN where there is no unique one.

    The ridge is some rounding errors high: it settles a system whose columns repeat one another in exact arithmetic.
    """
    size = np.trace(a, axis1=-2, axis2=-1)[..., None, None]
    firm = a + (1e-12 * size + (size == 0)) * np.eye(a.shape[-1])
    out = np.full(b.shape, np.nan)
    fine = np.isfinite(firm).all((-2, -1)) & np.isfinite(b).all(-1)
    if fine.any():
        out[fine] = np.linalg.solve(firm[fine], b[fine][..., None])[..., 0]
    return out
