"""Language identification by cross-parsing entropy.

Method. A suffix automaton is built of labelled text of each language: it follows exactly the substrings of that text. A document is cut from left to
right into phrases, each the longest match in the language's text, or one byte that does not occur there. Languages whose text is like the
document's need few phrases; their number times the logarithm of the labelled text's length, over the document's length, estimates
the cross entropy, and the least wins. Letters are lower-cased, all else is a space between words, and both are taken as
UTF-8 bytes.

Cost. Documents are labelled in place. The automata are complete tables over the bytes that occur, and a batch's texts are walked through them side
by side in stretches of 512 bytes, where a phrase ends at latest; one lookup a byte and language.

Bounds. At most `Sampling.languages` languages are learnt, the most frequent ones, each from at most `Sampling.letters` bytes of letters, all together from
at most `Sampling.all_letters`, of about `Sampling.documents` documents in the order of a hash of the id, of each at most a sixteenth of the language's share.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.compression import held_out
from ledgerloom.llm.shared import annotate, blank_null

STRETCH = 512
RUN_BYTES = 1 << 21
UNKNOWN = "und"
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_HASHES = 1 << 30


@dataclass(frozen=True)
class Sampling:
    languages: int = 512
    documents: int = 300
    letters: int = 48 << 10
    all_letters: int = 1 << 20

    def share(self, languages: int) -> int:
        return max(1, min(self.letters, self.all_letters // max(languages, 1)))


def letters_only(texts: pa.Array) -> pa.Array:
    """Lower-cased letters; every run of other characters is one space."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    return pc.replace_substring_regex(lowered, r"\PL+", " ")


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """The transitions of the smallest automaton of all substrings of `text`, by state; state 0 is the start."""
    steps, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(steps)
                steps.append(dict(steps[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return steps


class Parser:
    """Complete table of a language: from a state and a byte to twice the next state's row, plus one where a phrase begins.

    State 0 also stands for "no phrase yet", from which every byte begins one; a byte unknown to the language leads back to it.
    """

    def __init__(self, text: bytes):
        steps = suffix_automaton(text)
        self.symbol = np.zeros(256, np.uint8)  # 0: not in the language
        used = sorted(set(text))
        self.symbol[used] = np.arange(1, len(used) + 1)
        self.pad = len(used) + 1
        self.width = len(used) + 2
        begin = np.ones(self.width, np.int64)
        for c, to in steps[0].items():
            begin[self.symbol[c]] = to * self.width * 2 + 1
        table = np.tile(begin, (len(steps), 1))
        source = np.repeat(np.arange(1, len(steps)), [len(s) for s in steps[1:]])
        by = np.array([c for s in steps[1:] for c in s], np.int64)
        to = np.array([t for s in steps[1:] for t in s.values()], np.int64)
        table[source, self.symbol[by]] = to * self.width * 2
        table[:, self.pad] = np.arange(len(steps)) * self.width * 2
        self.table = table.ravel().astype(np.int32)
        self.bits = np.log2(len(text) + 1)

    def phrases(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of each stretch data[start:end], none longer than `STRETCH`."""
        order = np.argsort(starts - ends, kind="stable")
        starts, ends = starts[order], ends[order]
        symbols = np.append(self.symbol[data], np.uint8(self.pad))
        state = np.zeros(len(starts), np.int32)
        count = np.zeros(len(starts), np.int32)
        alive = np.searchsorted(starts - ends, -np.arange(STRETCH))  # stretches longer than t
        for t in range(int((ends - starts).max(initial=0))):
            m = alive[t]
            step = self.table[state[:m] + symbols[starts[:m] + t]]
            count[:m] += step & 1
            state[:m] = step >> 1
        out = np.empty_like(count)
        out[order] = count
        return out


@lru_cache(maxsize=1)
def _parsers(references: tuple[tuple[str, bytes], ...]) -> list[Parser]:
    """Built once in a worker, however many tasks it runs."""
    return [Parser(text) for _, text in references]


def _runs(texts: pa.Array):
    """(bytes, offsets) of a few million bytes of texts at a time."""
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = min(len(texts), max(first + 1, int(np.searchsorted(at, at[first] + RUN_BYTES, "right")) - 1))
        yield data[at[first] : at[stop]], at[first : stop + 1] - at[first]
        first = stop


def code_lengths(texts: pa.Array, parsers: list[Parser]) -> np.ndarray:
    """Bits of each of `texts` (letters and spaces) by each language: phrases times the logarithm of the language's text."""
    out = []
    for data, at in _runs(texts):
        pieces = -(-np.diff(at) // STRETCH)
        owner = np.repeat(np.arange(len(pieces)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = at[owner] + nth * STRETCH
        ends = np.minimum(starts + STRETCH, at[owner + 1])
        out.append(np.stack([np.bincount(owner, p.phrases(data, starts, ends), len(pieces)) * p.bits for p in parsers], 1))
    return np.concatenate(out) if out else np.zeros((0, len(parsers)))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sampling: Sampling = Sampling()) -> tuple[tuple[str, bytes], ...]:
    """(language, its text) learnt from labelled documents outside the held-out third, in the order of the languages.

    Rows without an id, a language or a text teach nothing, nor do texts without letters, nor those that the sample has under several languages. Copies of a text count once.
    """
    known = docs.select(F.col(key).cast("string").alias("id"), F.col(lang).alias("lang"), F.col(text).alias("body")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("body").isNotNull() & ~held_out(F.col("id")))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sampling.languages).collect()
    if not counts:
        return ()
    share = sampling.share(len(counts))
    drawn = F.pmod(F.xxhash64("id", F.lit(12)), F.lit(_HASHES))
    below = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], -(-sampling.documents * _HASHES // r["count"]))]), F.col("lang"))
    piece = F.substring("body", 1, 4 * (share // 16 + 1))  # of a document's share of letters, spaces and marks included
    picked = known.select("lang", drawn.alias("drawn"), below.cast("long").alias("below"), piece.alias("body")).where("drawn < below").distinct()
    rows = picked.orderBy("drawn", "lang", "body").limit(2 * sampling.documents * len(counts)).collect()
    clean = [t.strip().encode()[: share // 16 + 1] for t in letters_only(pa.array([r.body for r in rows], pa.string())).to_pylist()]
    said: dict[bytes, set[str]] = {}
    for r, own in zip(rows, clean):
        said.setdefault(own, set()).add(r.lang)
    found: dict[str, bytes] = {}
    for own, langs in said.items():  # in the order drawn, each text once
        if own and len(langs) == 1:
            (one,) = langs
            found[one] = (found.get(one, b"") + b" " + own)[:share]
    return tuple(sorted(found.items()))


def with_language(docs: DataFrame, references: tuple[tuple[str, bytes], ...], name: str, text: str = "text") -> DataFrame:
    """`docs` with struct `name`: lang_pred, score.

    The score is the language's share when every language weighs 2 to the power of minus its bits. A null text, one without a letter, and every text
    where no language was learnt is "und" with score 0. Languages that need the same bits: the first by code point, and a score of a
    half or less.
    """
    def prepare():
        parsers = _parsers(references)
        names = np.array([x for x, _ in references] + [UNKNOWN], object)

        def work(texts):
            clean = letters_only(texts)
            blank = pc.equal(pc.utf8_trim_whitespace(clean), "").to_numpy(zero_copy_only=False)
            if not parsers:
                best, score = np.zeros(len(clean), np.int64), np.zeros(len(clean))
            else:
                bits = code_lengths(clean, parsers)
                best = bits.argmin(1)
                score = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
                best[blank], score[blank] = len(parsers), 0
            return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], names=RESULT.fieldNames())

        return work

    return annotate(docs, [text], RESULT, name, prepare)


def languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sampling: Sampling = Sampling()) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of `docs`. Rows that repeat come back repeated, a null id is not held out. An empty table
    gives an empty result; other columns are not read."""
    references = fit(docs, text, lang, key, sampling)
    slim = docs.select(F.col(key).alias("doc_id"), blank_null(F.col(text)).alias("text"))
    return with_language(slim, references, "found", "text").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score")
