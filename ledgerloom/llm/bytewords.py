"""Words of whole Arrow text columns as NumPy arrays: spans and 64-bit hashes over the UTF-8 bytes.

Texts are worked on in runs of a few million bytes, so that memory follows the run, not the batch. A text
longer than a run is a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 21
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


class Run(NamedTuple):
    first: int  # row of the batch
    bytes: np.ndarray
    offsets: np.ndarray  # bytes, one more than rows
    starts: np.ndarray  # of words
    ends: np.ndarray
    words: np.ndarray  # index of each row's first word, one more than rows


def runs(texts: pa.Array, is_space: np.ndarray = _SPACE, run_bytes: int = RUN_BYTES) -> Iterator[Run]:
    """Nulls count as empty. `is_space` says for each byte value whether it parts words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(at, at[first] + run_bytes, "right")) - 1)
        stop = min(stop, len(texts))
        buf, offsets = data[at[first] : at[stop]], at[first : stop + 1] - at[first]
        starts, ends = _spans(buf, offsets, is_space)
        yield Run(first, buf, offsets, starts, ends, np.searchsorted(starts, offsets))
        first = stop


def _spans(buf, offsets, is_space):
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~is_space[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | begins[1:]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _tables(n):
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, RUN_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
            _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)
    return _powers, _inverses


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; not in place."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(run: Run) -> np.ndarray:
    """A hash of each word's bytes, the same wherever the word stands."""
    if not len(run.starts):
        return np.zeros(0, np.uint64)
    power, inverse = _tables(len(run.bytes) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(run.bytes) + 1, np.uint64)
        np.cumsum((run.bytes.astype(np.uint64) + np.uint64(1)) * power[: len(run.bytes)], out=total[1:])
        h = (total[run.ends] - total[run.starts]) * inverse[run.starts]
    return mixed(h)


def joined(*hashes: np.ndarray) -> np.ndarray:
    """One hash of several in order."""
    with np.errstate(over="ignore"):
        h = hashes[0]
        for k, other in enumerate(hashes[1:]):
            h = h * np.uint64(0x2545F4914F6CDD1D) + other + np.uint64(k + 1)
    return mixed(h)


def grams(h: np.ndarray, run: Run, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows that lie within one text, and the index of each window's first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.repeat(run.words[1:], np.diff(run.words))  # end of the text of each word
    at = np.flatnonzero(np.arange(len(h)) + n <= last)
    return joined(*[h[at + k] for k in range(n)]), at
