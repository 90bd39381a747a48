"""Quality rules: base counts, and a likelihood ratio between trusted and raw text.

Method. Words and pairs of adjacent words are hashed into `BUCKETS` buckets. Two multinomials over the buckets are
estimated with add-one smoothing: one from the texts trusted as target, one from all texts. A text's score is the sum of
log ratios of its words and pairs divided by their number; it is kept if the score reaches a fixed threshold. Log
ratios are rounded to whole millionths before they are added, so the sum, and with it every decision, is the same in
any order and layout.

Cost. One pass counts: the labels meet the texts in a hash join, in which texts move once, and each task sends at most one row per bucket.
A second pass scores in place. The model is `BUCKETS` numbers, whatever the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.bytewords import grams, joined, runs, word_hashes
from ledgerloom.llm.shared import annotate

BUCKETS = 1 << 16
#: In nats for a word or pair: clean text lies about zero, as most of the raw text is like it; text that is made of other words or pairs far below.
THRESHOLD = -0.18
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
MICRO = 1_000_000
WINDOW_WORDS = 3
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = T.StructType([*[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("micro", T.LongType()), T.StructField("n_grams", T.LongType())])

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = 1


def _per_text(values, offsets):
    """Sums of `values` between `offsets`."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _features(run, hashes):
    """Buckets of all words and pairs, and the text of each."""
    pairs, at = grams(hashes, run, 2)
    text = np.repeat(np.arange(len(run.words) - 1), np.diff(run.words))
    both = np.concatenate([hashes, pairs])
    return (both & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate([text, text[at]])


def repeated_words(run, hashes) -> np.ndarray:
    """For each text the words in windows of three words that it has twice or more."""
    window, at = grams(hashes, run, WINDOW_WORDS)
    text = np.repeat(np.arange(len(run.words) - 1), np.diff(run.words))
    window = joined(window, text[at].astype(np.uint64))  # only within a text
    order = np.argsort(window)
    window = window[order]
    same = window[1:] == window[:-1]
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    covered = np.zeros(len(hashes) + WINDOW_WORDS, np.int64)
    for k in range(WINDOW_WORDS):
        covered[at[order[repeated]] + k] = 1
    return _per_text(covered[: len(hashes)], run.words)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def base_counts(run, hashes) -> list[np.ndarray]:
    first_bytes = (run.bytes & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(first_bytes, dtype=np.int64)])
    return [np.diff(run.words), _per_text(chars[run.ends] - chars[run.starts], run.words), _per_text(_SYMBOL[run.bytes], run.offsets),
            np.array([repeated_lines(run.bytes[a:b].tobytes()) for a, b in zip(run.offsets, run.offsets[1:])], np.int64),
            repeated_words(run, hashes)]


def counts_by_bucket(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(bucket, raw, target): how often each bucket occurs in all texts and in those with label 1. An id counts once, however many
    labels it has; rows that repeat an id all count."""
    trusted = labels.where(F.col(label) == 1).select(F.col(key).alias("id")).distinct().withColumn("trusted", F.lit(1))
    marked = docs.select(F.col(key).alias("id"), F.col(text).alias("body")).join(trusted.hint("shuffle_hash"), "id", "left").select("body", "trusted")

    def count(stream):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in stream:
            trusted = np.asarray(batch.column(1).is_valid())
            for run in runs(batch.column(0)):
                bucket, of = _features(run, word_hashes(run))
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                total[1] += np.bincount(bucket[trusted[run.first + of]], minlength=BUCKETS)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, total[0][seen], total[1][seen])], ["bucket", "raw", "target"])

    counted = marked.mapInArrow(count, "bucket long, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """In millionths, for each bucket: log target share less log raw share. Zero throughout without target text."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # at most BUCKETS rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.any():
        return np.zeros(BUCKETS, np.int64)
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return np.rint(ratio * MICRO).astype(np.int64)


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, the base counts, base_failed, score (nats per word or pair), kept.

    A null text is an empty one: it has no words, fails the base rules and scores zero. Labels that are null or not 1 trust nothing; without any every score is zero.
    Texts of any length are read whole. Rows that repeat come back repeated and count each time; a null id comes back null. Other columns are not read. An empty table gives
    an empty result.
    """
    ratios = log_ratios(counts_by_bucket(docs, labels, text, key, label))

    def prepare():
        def work(texts):
            parts = []
            for run in runs(texts):
                hashes = word_hashes(run)
                bucket, of = _features(run, hashes)
                n = len(run.offsets) - 1
                micro = np.zeros(n, np.int64)
                np.add.at(micro, of, ratios[bucket])
                parts.append([*base_counts(run, hashes), micro, np.bincount(of, minlength=n)])
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(RESULT)
            return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], RESULT.names)

        return work

    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    counted = annotate(slim, ["text"], RESULT, "found", prepare).select("doc_id", "found.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    score = F.when(F.col("n_grams") > 0, F.col("micro") / F.col("n_grams") / MICRO).otherwise(0.0)
    return counted.withColumn("base_failed", failed).withColumn("score", score).select(
        "doc_id", *_COUNTS, "base_failed", "score", (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))
