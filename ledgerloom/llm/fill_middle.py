"""Fill-in-the-middle rewriting of documents.

Method. A text is held as its UTF-8 bytes and a sparse index of exceptions: for every character of more than one byte its position and its
excess bytes. Between exceptions characters and bytes advance together, so a cut is converted from bytes to characters or
back by one binary search among the exceptions and a subtraction; pure ASCII has none. Cuts are drawn from a hash of the id, in units of lines or
characters.

Cost. Texts are worked on in place, a batch at a time, all cuts of a batch at once; nothing is shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import annotate, fresh

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100  # per cent of documents that are rewritten
SUFFIX_FIRST = 50  # per cent of those whose suffix comes before the prefix
RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])


class Exceptions(NamedTuple):
    """Where the characters of several bytes stand in `bytes`, in bytes and in characters, and the excess before each; one more excess at the end."""

    byte: np.ndarray
    char: np.ndarray
    excess: np.ndarray

    @staticmethod
    def of(data: np.ndarray) -> Exceptions:
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)])
        return Exceptions(at, at - excess[:-1], excess)

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Characters before these byte positions, which begin characters."""
        return byte - self.excess[np.searchsorted(self.byte, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Byte positions of these characters."""
        return char + self.excess[np.searchsorted(self.char, char)]


def _buffers(texts: pa.Array):
    """Bytes of all texts and where each begins, one more than texts."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def _line_cuts(data, at):
    """Lines of each text, and the byte at which its first k lines end."""
    breaks = np.flatnonzero(data == 10)
    first = np.searchsorted(breaks, at)
    found = np.diff(first)
    open_end = np.zeros(len(found), np.int64)
    some = np.flatnonzero(np.diff(at))
    open_end[some] = data[at[1:][some] - 1] != 10
    ends = np.concatenate([breaks + 1, [0]])

    def cut(k):
        inside = ends[np.minimum(first[:-1] + np.maximum(k, 1) - 1, len(breaks))]
        return np.where(k == 0, at[:-1], np.where(k <= found, inside, at[1:]))

    return found + open_end, cut


def rewrite(texts: pa.Array, draws: list[np.ndarray], unit: str = "line", rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> pa.StructArray:
    """The struct of `RESULT` for every text; `draws` are four arrays of numbers from 0 on."""
    texts = pc.fill_null(texts, "")
    data, at = _buffers(texts)
    index = Exceptions.of(data)
    if unit == "line":
        n, cut = _line_cuts(data, at)
    else:
        begin = index.chars(at)
        n, cut = np.diff(begin), lambda k: index.bytes(begin[:-1] + k)
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    lo, hi = cut(np.minimum(one, two)), cut(np.maximum(one, two))
    marked = np.zeros(len(texts), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    plain = marked | (np.diff(at) == 0) | (draws[2] % 100 >= rate)
    spm = draws[3] % 100 < suffix_first
    chars = index.chars(lo) - index.chars(at[:-1]), index.chars(hi) - index.chars(lo)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    whole, out = data.tobytes(), []
    for a, b, c, z, as_is, suffix_leads in zip(at[:-1].tolist(), lo.tolist(), hi.tolist(), at[1:].tolist(), plain.tolist(), spm.tolist()):
        if as_is:
            out.append(whole[a:z])
        elif suffix_leads:
            out.append(b"".join((s, whole[c:z], p, whole[a:b], m, whole[b:c])))
        else:
            out.append(b"".join((p, whole[a:b], s, whole[c:z], m, whole[b:c])))
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).astype(object), pa.string()),
         *[pa.array(x, pa.int64(), mask=plain) for x in chars], pa.array(out, pa.binary()).cast(pa.string())],
        names=RESULT.fieldNames())


def _draws(key: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def with_middle(docs: DataFrame, name: str, text: str = "text", key: str = "doc_id", unit: str = "line", rate: int = RATE,
                suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """`docs` with a struct `name`: n (units of the text), form (plain, psm or spm), prefix_chars, middle_chars, output (the text to train on).

    `unit` is "line" or "char". A text is plain, its output itself and its character counts null, if it is empty or null, holds one of the
    three marks, or is not drawn by `rate`. The draws depend on the id alone, so rows that repeat are rewritten alike; a null id draws as an empty
    one. Other columns stay. An empty table gives an empty result.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit {unit}")
    columns = docs.columns
    names = fresh(docs, "draw1", "draw2", "draw3", "draw4")
    drawn = docs.withColumns(dict(zip(names, _draws(F.col(key), seed))))

    def prepare():
        return lambda texts, *draws: rewrite(texts, [d.to_numpy() for d in draws], unit, rate, suffix_first)

    return annotate(drawn, [text, *names], RESULT, name, prepare).select(*columns, name)


def restored(output: Column, form: Column) -> Column:
    """The text that `with_middle` rewrote."""
    def between(first, last):
        begin = F.locate(first, output) + len(first)
        return F.substring(output, begin, (F.locate(last, output) - begin) if last else F.length(output))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def middle_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 per row of `docs`."""
    made = with_middle(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "made", "text", "doc_id")
    back = restored(F.col("made.output"), F.col("made.form"))
    return made.select("doc_id", "made.n", "made.form", "made.prefix_chars", "made.middle_chars",
                       F.sha2("made.output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
