"""Benchmark decontamination by edit distance over words.

Method. The CGK random walk turns edit distance into Hamming distance: it reads a sequence from some word on, emits the
current word at each step, and moves on or stays as a random bit of (step, word) says, so that two walks over texts
with an edit between them fall into step again. From every word of a document and every word of an item a walk sets out,
and each repetition samples a few of its steps. Equal samples propose the item-sized window of the document in which the item's
word would stand on the document's; proposals are verified by exact edit distance, in words, against any stretch of
the document about the window. A document holds an item if at most `1 - similarity` of the item's words
would have to be inserted, deleted or changed.

Recall. An item is missed only if all repetitions from all its words fail. Walks need some words to fall into step again, so items of
fewer than `SHORT_WORDS` words are proposed by their own adjacent words, of which some survive all edits that the default similarity allows: an edit
touches three triples at most, and 0.6 n are fewer than the n - 2 triples of n words from 6 on; below that pairs do, and a lone word is itself. None of
these is missed. From `SHORT_WORDS` words on at least 98 % are found with as many edits as allowed, at random places or evenly spread (the tests measure it
length by length). A similarity so low that edits may touch every triple has no such proof.

Words are lower-cased runs of letters, digits and non-ASCII characters: punctuation and line breaks do not hide a passage.

Cost. The items go to every task, in blocks of at most `ITEM_WORDS` words with one pass over the documents each.
Documents do not move. A walk is dropped at the first sampled word at which no item's walk is like it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.bytewords import mixed, runs, word_hashes
from ledgerloom.llm.shared import annotate, fresh

SIMILARITY = 0.8
REPETITIONS = 7
SAMPLES = 6
ITEM_WORDS = 250_000
SHORT_WORDS = 20
TRIPLE_WORDS = 6  # from here on three adjacent words propose a short item, below two
_SEED = 20_231
_HIT = pa.struct([("item", pa.int32()), ("distance", pa.int32()), ("last_word", pa.int64())])
RESULT = T.StructType([T.StructField("hits", T.ArrayType(T.StructType([
    T.StructField("item", T.IntegerType()), T.StructField("distance", T.IntegerType()),
    T.StructField("last_word", T.LongType())])))])

_PARTS_WORDS = np.ones(256, bool)
_PARTS_WORDS[128:] = False
_PARTS_WORDS[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8)] = False


def _sample_steps(repetition: int) -> list[int]:
    """The steps at which a repetition samples: 0, then further ones two or three steps apart."""
    rng = np.random.default_rng([_SEED, repetition])
    return [0, *np.cumsum(rng.integers(2, 4, SAMPLES - 1)).tolist()]


def _walk_bits(hashes):
    """For each word sixteen random bits for each repetition, which is more than a walk takes steps."""
    four = [mixed(hashes ^ np.uint64(0x9E37_79B9_7F4A_7C15 * (k + 1) % 2**64)) for k in range((REPETITIONS + 3) // 4)]
    return [(four[r // 4] >> np.uint64(16 * (r % 4))).astype(np.uint16) for r in range(REPETITIONS)]


class _Keys:
    """A set of longs: a table of their low bits rules most others out before the exact look-up."""

    def __init__(self, keys):
        self.keys = np.unique(keys)
        self.bits = np.int64((1 << max(16, int(len(self.keys)).bit_length() + 4)) - 1)
        self.maybe = np.zeros(int(self.bits) + 1, bool)
        self.maybe[self.keys & self.bits] = True

    def holds(self, keys):
        out = self.maybe[keys & self.bits]
        some = np.flatnonzero(out)
        if len(some):
            at = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
            out[some] = self.keys[at] == keys[some]
        return out


class Items:
    """The items of one block, ready to be looked for. Built anew in each task from the words' hashes."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, similarity: float = SIMILARITY):
        self.words, self.starts = words, starts
        self.sizes = np.diff(starts)
        self.allowed = np.floor(self.sizes * (1 - similarity) + 1e-9).astype(int)
        self.vocabulary = np.unique(words)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[words & np.uint64(0xFFFFF)] = True
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.ids = np.searchsorted(self.vocabulary, words).astype(np.int64)
        self.base = np.int64(len(self.vocabulary) + 1)
        self.long = (self.sizes >= SHORT_WORDS)[self.owner] if len(words) else np.zeros(0, bool)
        self.steps = [_sample_steps(r) for r in range(REPETITIONS)]
        bits = _walk_bits(words)
        self.tables = [self._table(r, bits[r]) for r in range(REPETITIONS)] if self.long.any() else []
        self.short = self._short_table()
        common = np.bincount(self.ids, minlength=len(self.vocabulary))[self.ids] if len(words) else self.ids
        #: Of each item its least common words, one more than may be lost: of these a copy has at least one.
        self.rare = [lo + np.argsort(common[lo:hi], kind="stable")[: k + 1] for lo, hi, k in zip(starts, starts[1:], self.allowed)]

    def _table(self, repetition, bits):
        """For each sample the keys walks may have by then; at last the keys in order with the words they set out from."""
        ends = self.starts[1:][self.owner]
        at = np.flatnonzero(self.long)
        levels = []
        for key, at in self._walk(bits, self.ids, ends, at, repetition):
            levels.append(_Keys(key))
        order = np.argsort(key, kind="stable")
        return levels, key[order], at[order]

    def _walk(self, bits, ids, ends, at, repetition, levels=None):
        """Keys of the walks from `at` that are still alive, sample after sample."""
        here, key, step = at, None, 0
        for k, sample in enumerate(self.steps[repetition]):
            while step < sample:
                here = here + ((bits[np.minimum(here, len(bits) - 1)] >> np.uint16(step)) & np.uint16(1))
                step += 1
            alive = here < ends[at]
            if not alive.all():
                here, at, key = here[alive], at[alive], key if key is None else key[alive]
            word = ids[here]
            key = word + 1 if key is None else self._joined(key, word)
            alive = word >= 0
            if levels is not None and k:
                alive &= levels[k].holds(key)
            here, at, key = here[alive], at[alive], key[alive]
            yield key, at

    def _joined(self, key, word):
        with np.errstate(over="ignore"):
            return key * np.int64(0x5851F42D4C957F2D) + word + 1

    def _short_table(self):
        """By how many adjacent words are joined: the keys of the short items in order, and the words they begin at."""
        at, tables = np.flatnonzero(~self.long), []
        for n in (1, 2, 3):
            size = self.sizes[self.owner[at]] if len(at) else at
            own = at[np.where(size >= TRIPLE_WORDS, 3, np.minimum(size, 2)) == n]
            own = own[own + n <= self.starts[1:][self.owner[own]]] if len(own) else own
            keys = self._adjacent(self.ids, own, n)
            order = np.argsort(keys, kind="stable")
            tables.append((keys[order], own[order]))
        return tables

    def _adjacent(self, ids, at, n):
        key = ids[at] + 1
        for k in range(1, n):
            key = self._joined(key, ids[at + k])
        return key

    def proposals(self, hashes, ends):
        """(position in the document, word of the item) of all equal samples."""
        ids = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.maybe[hashes & np.uint64(0xFFFFF)])
        found = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        same = self.vocabulary[found] == hashes[maybe]
        ids[maybe[same]] = found[same]
        known = np.flatnonzero(ids >= 0)
        bits = _walk_bits(hashes) if self.tables else []
        out = []
        for repetition, (levels, keys, words) in enumerate(self.tables):
            for key, at in self._walk(bits[repetition], ids, ends, known, repetition, levels):
                pass
            out.append(_matches(key, at, keys, words))
        at = known
        for n, (keys, words) in enumerate(self.short, 1):
            if n > 1:  # all n words are known and in the same text
                at = at[at + n <= ends[at]]
                at = at[ids[at + n - 1] >= 0]
            if len(keys):
                out.append(_matches(self._adjacent(ids, at, n), at, keys, words))
        at, words = (np.concatenate(x) for x in zip(*out))
        return at, words

    def _cases(self, at, words, row, firsts):
        """Distinct (row, item, start) in the order of items. A start too far before its text to be one is left out."""
        item, row = self.owner[words], row[at]
        start = at - (words - self.starts[item])
        most = int(self.allowed.max()) + 1
        ok = start >= firsts[row] - self.allowed[item]
        item, row, start = item[ok], row[ok], start[ok]
        width = int(firsts[-1]) + (len(firsts) + 1) * most
        code = np.unique(item * width + row * most + start + most)
        item, place = np.divmod(code, width)
        filled = np.flatnonzero(np.diff(firsts))
        row = filled[np.searchsorted(firsts[filled] + filled * most, place - 1, "right") - 1]  # where a row's codes begin
        return np.stack([row, item, place - most - row * most])

    def _possible(self, hashes, cases, firsts):
        """The cases (row, item, start) whose window has enough of the item's words, each no further from its place than
        the allowed number of words."""
        out = [np.zeros((3, 0), np.int64)]
        bounds = np.flatnonzero(np.diff(cases[1], prepend=-1, append=-1))
        for lo, hi in zip(bounds, bounds[1:]):
            some, i = cases[:, lo:hi], int(cases[1, lo])
            begin, end, k = int(self.starts[i]), int(self.starts[i + 1]), int(self.allowed[i])
            some = self._with_words(hashes, some, firsts, begin, self.rare[i], k, 1)
            out.append(self._with_words(hashes, some, firsts, begin, np.arange(begin, end), k, end - begin - k))
        return np.concatenate(out, axis=1).T

    def _with_words(self, hashes, cases, firsts, begin, wanted, k, enough):
        parts = []
        for part in np.array_split(cases, cases.shape[1] * len(wanted) // 200_000 + 1, axis=1):
            lowest, highest = firsts[part[0]][:, None], firsts[part[0] + 1][:, None] - 1
            hit = np.zeros((part.shape[1], len(wanted)), bool)
            for shift in range(-k, k + 1):
                place = part[2][:, None] + (wanted - begin + shift)
                here = hashes[np.clip(place, lowest, highest)]
                hit |= (here == self.words[wanted]) & (place >= lowest) & (place <= highest)
            parts.append(part[:, hit.sum(1) >= enough])
        return np.concatenate(parts, axis=1)

    def search(self, hashes, firsts):
        """[(row, item, distance, last word)] of one run of documents; `firsts` are the rows' first words."""
        if not len(hashes) or not len(self.words):
            return []
        row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        at, words = self.proposals(hashes, firsts[1:][row])
        best = {}
        for r, i, s in self._possible(hashes, self._cases(at, words, row, firsts), firsts).tolist():
            n, k = int(self.sizes[i]), int(self.allowed[i])
            if best.get((r, i), (k + 1,))[0] == 0:
                continue
            lo, hi = max(s - k, int(firsts[r])), min(s + n + k, int(firsts[r + 1]))
            passage, wanted = hashes[lo:hi], self.words[self.starts[i] : self.starts[i + 1]]
            distance, last = best_match(wanted, passage, k)
            if distance <= k:
                best[r, i] = min(best.get((r, i), (k + 1, 0)), (distance, lo + last - int(firsts[r])))
        return [(r, i, *found) for (r, i), found in sorted(best.items())]


def best_match(wanted: np.ndarray, passage: np.ndarray, allowed: int) -> tuple[int, int]:
    """The least edit distance of `wanted` to any stretch of `passage`, and where the first such stretch ends.

    Gives up with `allowed + 1` once the distance must exceed `allowed`.
    """
    steps = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for k, word in enumerate(wanted):
        changed = row[:-1] + (passage != word)
        row = np.minimum(row + 1, np.concatenate([[k + 1], changed]))
        row = np.minimum.accumulate(row - steps) + steps
        if row.min() > allowed:
            return allowed + 1, 0
    return int(row.min()), int(row.argmin())


def _matches(key, at, keys, words):
    lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    n = hi - lo
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(at, n), words[np.repeat(lo, n) + within]


def _lowered(texts):
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def text_words(texts: pa.Array):
    """(first row, hashes of words, index of each row's first word) for one run of texts after another."""
    for run in runs(_lowered(texts), _PARTS_WORDS):
        yield run.first, word_hashes(run), run.words


def item_blocks(benchmark: DataFrame, text: str = "text", key: str = "item_id", most: int = ITEM_WORDS):
    """The items, read one block after another: (ids, words, starts) with at most `most` words, but one item at least."""
    ids, words, starts = [], [], [0]
    for row in benchmark.select(F.col(key).alias("k"), F.col(text).alias("t")).toLocalIterator():
        (_, hashes, _), = text_words(pa.array([row["t"]], pa.string()))
        if starts[-1] and starts[-1] + len(hashes) > most:
            yield ids, np.concatenate(words), np.array(starts)
            ids, words, starts = [], [], [0]
        if len(hashes):
            ids.append(row["k"])
            words.append(hashes)
            starts.append(starts[-1] + len(hashes))
    if ids:
        yield ids, np.concatenate(words), np.array(starts)


def with_hits(docs: DataFrame, block, name: str, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with struct `name`, whose `hits` list what of one block each text holds."""
    _, words, starts = block

    def prepare():
        items = Items(words, starts, similarity)

        def work(texts):
            hits = [[] for _ in range(len(texts))]
            for first, hashes, firsts in text_words(texts):
                for r, i, distance, last in items.search(hashes, firsts):
                    hits[first + r].append({"item": i, "distance": distance, "last_word": last})
            return pa.StructArray.from_arrays([pa.array(hits, pa.list_(_HIT))], ["hits"])

        return work

    return annotate(docs, [text], RESULT, name, prepare)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
                 similarity: float = SIMILARITY) -> DataFrame:
    """One row for each row of `docs` and item it holds: doc_id, item_id, distance, item_words, last_word (the index of the
    word after the first best match).

    Null and empty texts hold nothing; items without words are in nothing; repeated rows and repeated items each count. Texts of any length are read whole. An empty table or benchmark gives
    an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for block in item_blocks(benchmark):
        ids = spark.createDataFrame(
            [(n, k, int(size)) for n, (k, size) in enumerate(zip(block[0], np.diff(block[2])))],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", benchmark.schema["item_id"].dataType),
                          T.StructField("item_words", T.LongType())]))
        hits = with_hits(slim, block, "found", "text", similarity).select("doc_id", F.inline("found.hits"))
        hits = hits.join(F.broadcast(ids), "item").select("doc_id", "item_id", "distance", "item_words", "last_word")  # a block's rows
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        return slim.where(F.lit(False)).select(
            "doc_id", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("distance"),
            F.lit(0).cast("long").alias("item_words"), F.lit(0).cast("long").alias("last_word"))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` whose text holds no item, unchanged: null and empty texts, repeated rows, null ids and other columns stay. Texts of any length are read whole. An empty
    benchmark takes nothing away; an empty table gives an empty result."""
    columns = docs.columns
    (name,) = fresh(docs, "found")
    for block in item_blocks(benchmark):
        docs = with_hits(docs, block, name, text, similarity).where(F.size(f"{name}.hits") == 0).select(columns)
    return docs
