"""Quality classifier by compression.

Method. One zstandard dictionary is trained on good texts and one on bad ones. A text is cut into blocks, all of which are
compressed with either; the bytes are summed to `good` and `bad`. The score is a logistic function of the normalised
difference (bad - good) / (bad + good) and of the logarithm of compressed size over plain size, which tells a text
that repeats itself, where both dictionaries do equally well. The function is fitted to labelled texts that are in
neither dictionary, each class weighted by its share of the labels.

Bounds. Dictionaries and fit see at most `Sampling.documents` labelled documents of each class, and of those as many as
`Sampling.text_bytes` holds, in the order of a hash of the id; texts of more than a sixteenth of that are not sampled. All documents are scored on their whole text. The model
is a few hundred kilobytes, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import annotate, blank_null, fresh

HOLD_OUT_REMAINDER = 1
BLOCK_BYTES = 1024
SAMPLE_BYTES = 512  # pieces in which texts are shown to the dictionary trainer
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


@dataclass(frozen=True)
class Sampling:
    documents: int = 1500
    text_bytes: int = 5 << 20


@dataclass(frozen=True)
class Model:
    """`good` and `bad` are None where a class has no labelled text; then every score is `share`."""

    good: bytes | None
    bad: bytes | None
    weights: tuple[float, ...]
    share: float

    def scorer(self):
        if self.good is None or self.bad is None:
            return lambda text: self.share
        measure, weights = _measure(self.good, self.bad), np.array(self.weights)
        return lambda text: float(1 / (1 + np.exp(-np.clip(measure(text) @ weights, -30, 30))))


def held_out(key):
    """Whether the row's label must not be learnt from: crc32 of the id as text leaves remainder 1 by 3. False without an id."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == HOLD_OUT_REMAINDER, F.lit(False))


def _compressor(dictionary):
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


def _measure(good, bad):
    good, bad = _compressor(good), _compressor(bad)

    def measure(text: bytes):
        g = b = 0
        for k in range(0, len(text), BLOCK_BYTES):
            block = text[k : k + BLOCK_BYTES]
            g += len(good.compress(block))
            b += len(bad.compress(block))
        return np.array([1.0, (b - g) / (b + g), np.log((b + g) / (2 * len(text)))]) if text else np.array([1.0, 0.0, 0.0])

    return measure


def _dictionary(texts: list[bytes]) -> bytes | None:
    pieces = [t[k : k + SAMPLE_BYTES] for t in texts for k in range(0, len(t), SAMPLE_BYTES)]
    if not pieces:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: all of it serves
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def _logistic(x, y, weight, ridge=1e-5, rounds=60):
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        spread = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * weight.sum() * np.eye(len(w))
        w = w + np.linalg.solve(spread, x.T @ (weight * (y - p)) - ridge * weight.sum() * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        sampling: Sampling = Sampling()) -> Model:
    """The model learnt from labelled documents outside the held-out third.

    An id with several labels counts as good if any is 1. Labels other than 0 and 1, labels without a document and documents
    without words teach nothing. Every third sampled document of a class is for the fit, the rest for its dictionary.
    """
    known = (labels.where(~held_out(F.col(key)) & F.col(key).isNotNull() & F.col(label).isin(0, 1))
             .groupBy(F.col(key).alias("id")).agg(F.max(label).alias("y")))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = F.xxhash64("id", F.lit(7))
    picked = [known.where(F.col("y") == y).withColumn("order", order).orderBy("order", "id").limit(sampling.documents)
              for y in (0, 1)]
    picked = F.broadcast(picked[0].unionByName(picked[1]))  # at most twice `documents` rows
    texts = docs.select(F.col(key).alias("id"), blank_null(F.col(text)).alias("body")).join(picked, "id")
    so_far = Window.partitionBy("y").orderBy("order", "id", "body")
    texts = texts.where(F.octet_length("body") <= sampling.text_bytes // 16)  # no text may use up the sample
    kept = texts.withColumn("bytes", F.sum(F.octet_length("body")).over(so_far)).where(F.col("bytes") <= sampling.text_bytes)
    found = {0: [], 1: []}
    for r in kept.orderBy("order", "id", "body").select("y", "body").toLocalIterator():
        found[r["y"]].append(r["body"].encode("utf-8", "replace"))
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    taught = [_dictionary([t for i, t in enumerate(found[y]) if i % 3 != 2]) for y in (0, 1)]
    if None in taught:
        return Model(None, None, (), share)
    measure = _measure(taught[1], taught[0])
    rest = {y: [t for i, t in enumerate(found[y]) if i % 3 == 2] or found[y] for y in (0, 1)}
    x = np.array([measure(t) for y in (0, 1) for t in rest[y]])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    weight = np.repeat([(1 - share) / len(rest[0]), share / len(rest[1])], [len(rest[0]), len(rest[1])]) * len(y)
    return Model(taught[1], taught[0], tuple(_logistic(x, y, weight)), share)


def with_quality(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """`docs` with struct `name`: score (0 to 1, higher is better) and predicted (1 from a score of 0.5).

    A null text is an empty one and gets the score that carries no evidence.
    """
    def prepare():
        score = model.scorer()

        def work(texts):
            texts = pc.fill_null(texts, "")
            scores = np.array([score(t.as_py().encode("utf-8", "replace")) for t in texts], np.float64)
            return pa.StructArray.from_arrays(
                [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["score", "predicted"])

        return work

    return annotate(docs, [text], RESULT, name, prepare)


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted. Nulls, empty texts and missing labels as in `keep_good`; texts of any length are read whole. An empty table gives
    an empty result."""
    model = fit(docs, labels, text, key)
    scored = with_quality(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), model, "judged", "text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "judged.score", "judged.predicted")


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that the classifier predicts to be good, unchanged: repeated rows, null ids and other columns stay. A null or empty text has the score of no evidence.
    Without labels of both kinds all rows share the share of good labels as score, a half where there are none. An empty table gives an empty result."""
    (name,) = fresh(docs, "judged")
    return with_quality(docs, fit(docs, labels, text, key), name, text).where(F.col(f"{name}.predicted") == 1).select(docs.columns)
