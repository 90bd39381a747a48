"""Near-duplicate documents by 64-bit SimHash over 3-word shingles.

Method. Each fingerprint is embedded as its bit counts per segment of four bits: sixteen counts, each 0 to 4. One
differing bit moves one count by one, so the Manhattan distance of two embeddings is at most their Hamming
distance. Two embeddings within Manhattan distance 2 have a common neighbour within distance 1 of both; so every
distinct fingerprint is placed in its own grid cell and in the up to 32 cells one step away, and whoever shares no
cell has no partner. What does share a cell is verified exactly there: a cell one step away stands for a few
fingerprints that differ in one bit, and two documents in it differ in two bits or fewer if and only if they reach
the same one. They are then linked through it, so that a group of thousands of near copies costs a star, not
all its pairs.

Cost. Texts are read once and not moved. Equal fingerprints are merged before the grid, which sends 33 pairs of
longs for each distinct one. Cells and centres hold distinct fingerprints and are reduced by minimum, in parts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.components import components
from ledgerloom.llm.shared import fresh, write_shared

SEED = 42
SHINGLE_WORDS = 3
_BLOCK = 1 << 14


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [tuple(words)]
    else:
        shingles = zip(*[words[k:] for k in range(SHINGLE_WORDS)])
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(s), SEED) for s in shingles), np.uint64).astype(">u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        ones += np.unpackbits(hashes[k : k + _BLOCK].view(np.uint8)).reshape(-1, 64).sum(0, np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint, na_action=None).astype("int64")


def _segment_counts(fp: Column) -> Column:
    """Bits set in each of the sixteen segments, as sixteen octal digits of one long."""
    digits = [F.bit_count(F.shiftrightunsigned(fp, 4 * k).bitwiseAND(F.lit(15))).cast("long") * F.lit(8**k) for k in range(16)]
    return reduce(lambda x, y: x + y, digits)


def _cells(counts: Column) -> Column:
    """The fingerprint's cell and those one step away that one changed bit can reach, with the segment and direction."""
    out = [F.struct(counts.alias("cell"), F.lit(-1).alias("segment"), F.lit(False).alias("up"))]
    for k in range(16):
        n, step = F.shiftrightunsigned(counts, 3 * k).bitwiseAND(F.lit(7)), F.lit(8**k)
        for up, possible, cell in ((True, n < 4, counts + step), (False, n > 0, counts - step)):
            out.append(F.when(possible, F.struct(cell.alias("cell"), F.lit(k).alias("segment"), F.lit(up).alias("up"))))
    return F.array_compact(F.array(*out))


def _centres(fp: Column, segment: Column, up: Column) -> Column:
    """The fingerprints in a cell that differ from `fp` in one bit of the segment, or `fp` itself in its own cell."""
    flipped = []
    for bit in range(4):
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), (segment * 4 + bit).cast("int"))
        flipped.append(F.when((fp.bitwiseAND(mask) == 0) == up, fp.bitwiseXOR(mask)))
    return F.when(segment < 0, F.array(fp)).otherwise(F.array_compact(F.array(*flipped)))


def near_links(fingerprints: DataFrame) -> DataFrame:
    """(a, b), a > b: links that join all of the distinct longs `fp` within two bits of each other, directly or through
    the smallest that shares a centre with them."""
    counted = fingerprints.select("fp", _segment_counts(F.col("fp")).alias("counts"))
    placed = counted.select("fp", F.inline(_cells(F.col("counts"))))
    shared = placed.groupBy("cell").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("cell")
    reached = placed.join(shared, "cell", "left_semi").select(
        "fp", F.explode(_centres(F.col("fp"), F.col("segment"), F.col("up"))).alias("centre"))
    reached = write_shared(reached, "simhash-centres")
    least = reached.groupBy("centre").agg(F.min("fp").alias("b"), F.max("fp").alias("hi")).where("b < hi")
    return (reached.join(least.select("centre", "b"), "centre").where("fp > b")
            .select(F.col("fp").alias("a"), "b").distinct())


def _rooted(prints: DataFrame, least) -> tuple[DataFrame, DataFrame]:
    """(fp, root, least) per distinct fingerprint, least being the smallest of the column `least`, and (root, least) per group."""
    distinct = write_shared(prints.groupBy("fp").agg(F.min(least).alias("least")), "simhash-distinct")
    groups = components(near_links(distinct.select("fp")))
    labelled = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return labelled, labelled.groupBy("root").agg(F.min("least").alias("least"))


def simhash_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest id reachable).

    Links join fingerprints that differ in two bits or fewer. A null text is an empty one; a text without words has
    fingerprint zero and is linked like any other. Texts of one or two words are one shingle. Repeated rows come back
    repeated; a null id comes back null and names no component, so a group of nulls alone has a null component_id. Other columns are
    not read. An empty table gives an empty result.
    """
    prints = write_shared(docs.select(F.col(key).alias("doc_id"), _fingerprints(F.col(text)).alias("fp")), "simhash-prints")
    labelled, least = _rooted(prints, "doc_id")
    named = write_shared(labelled.select("fp", "root").join(least, "root").select("fp", F.col("least").alias("component_id")), "simhash-named")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`docs` with one document of each group of `simhash_groups`, the one with the smallest id; all columns stay.

    Each group keeps the row of its least id, of several rows with that id the one of least hash; so an id with different texts may stay
    more than once. Rows that are the same are one. Null and empty texts and those without words are one group. Rows without an id
    cannot be named and all stay. An empty table gives an empty result.
    """
    (row,) = fresh(docs, "row")
    hashed = F.xxhash64(*docs.columns)
    named = docs.where(F.col(key).isNotNull())
    prints = write_shared(named.select(F.col(key).alias("doc_id"), hashed.alias("row"), _fingerprints(F.col(text)).alias("fp")), "simhash-prints")
    _, least = _rooted(prints, F.struct("doc_id", "row"))
    keep = write_shared(least.select(F.col("least.doc_id").alias(key), F.col("least.row").alias(row)), "simhash-kept")
    kept = named.withColumn(row, hashed).join(keep, [key, row], "left_semi").dropDuplicates([key, row])
    return kept.select(docs.columns).unionByName(docs.where(F.col(key).isNull()))
