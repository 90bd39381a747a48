"""URL filter: host and path rules, and a blocklist of domains in a cascade of Bloom filters.

Method. The first filter holds the listed domains. It also lets some other domains of the corpus through: the second filter
holds those, the third the listed ones that the second lets through, and so on until nothing is let through wrongly. Because
all domains that the corpus has were tried, membership is exact for every one of them, and looking one up takes no join: the
filters are a few constants in the expression. The first filter is sized so that about as many domains pass wrongly as are
listed, later ones to pass half, which makes the cascade smallest.

All is DataFrame expressions. The corpus's domains are made distinct in parts before the shuffle. The filters come to the
driver as bits, and each stands once in the expression. Their size follows the blocklist, not the corpus: a list that needs more
than `MOST_BITS` is split by a hash of the domains into shards with a cascade each, and the pages pass them one after another, so
that neither a task nor the driver's expression holds more than one shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import write_shared

MOST_BITS = 1 << 27
WRONG_PER_LISTED = math.sqrt(2)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self):
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: bytes  # bit k of the filter is bit k % 8 of byte k / 8


@dataclass(frozen=True)
class Shard:
    number: int
    of: int


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty where there is none."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url):
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def domain_at(host: Column, depth: int) -> Column:
    """The last `depth` labels of the host, or all of it where it has fewer."""
    return F.substring_index(host, ".", -depth)


def _position(key, level, number, bits):
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(number)), F.lit(bits))


def _passes(key: Column, level: int, stage: Level) -> Column:
    def is_set(at):
        byte = F.ascii(F.decode(F.substr(F.lit(stage.words), (F.floor(at / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
        return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    return F.forall(F.array(*[_position(key, level, number, stage.bits) for number in range(stage.hashes)]), is_set)


def listed(key: Column, cascade: tuple[Level, ...]) -> Column:
    """Whether the key is listed; exact for every key the cascade was built over."""
    out = F.lit(False)
    for level in range(len(cascade) - 1, -1, -1):
        out = _passes(key, level, cascade[level]) & ~out
    return out


def _hashes(share_wrong):
    return max(1, round(-math.log2(share_wrong)))


def _filter(keys: DataFrame, level: int, n: int, share_wrong: float) -> Level:
    hashes = _hashes(share_wrong)
    bits = max(64, math.ceil(n * hashes / math.log(2) / 64) * 64)
    at = keys.select(F.explode(F.array(*[_position(F.col("key"), level, k, bits) for k in range(hashes)])).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    set_words = at.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(bit).alias("value"))
    words = bytearray(bits // 8)
    for r in set_words.toLocalIterator():  # bits / 64 rows at most
        words[8 * r["word"] : 8 * r["word"] + 8] = r["value"].to_bytes(8, "little", signed=True)
    return Level(bits, hashes, bytes(words))


def _levels(inside: DataFrame, outside: DataFrame, wrong: float) -> tuple[Level, ...]:
    n, levels = inside.count(), []
    while n:
        level = _filter(inside, len(levels), n, wrong)
        through = write_shared(outside.where(_passes(F.col("key"), len(levels), level)), "cascade-through")
        levels.append(level)
        inside, outside, n, wrong = through, inside, through.count(), 0.5
    return tuple(levels)


def in_shard(key: Column, shard: Shard) -> Column:
    return F.lit(True) if shard.of == 1 else F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shard.of)) == shard.number


def cascade_of(blocked: DataFrame, universe: DataFrame) -> tuple[Level, ...]:
    """The one cascade of a list that needs no shards."""
    (_, cascade), = cascades_of(blocked, universe)
    return cascade


def cascades_of(blocked: DataFrame, universe: DataFrame, most_bits: int = MOST_BITS) -> Iterator[tuple[Shard, tuple[Level, ...]]]:
    """The cascades that hold the keys of `blocked` among those of `universe` (both one column `key`), one for each shard. Nulls are no keys; an empty list gives one cascade without levels, and nothing is listed.

    The second filter may be larger than the first: it holds up to twice the listed keys at one hash each, hence the least of two hashes here. A quarter of
    `most_bits` is left for shards that are larger than others.
    """
    inside = write_shared(blocked.where("key is not null").distinct(), "cascade-listed")
    outside = write_shared(universe.where("key is not null").distinct().join(inside, "key", "left_anti"), "cascade-others")
    n, others = inside.count(), outside.count()
    wrong = min(0.5, max(1e-6, WRONG_PER_LISTED * n / max(others, 1)))
    bits = n * max(2, _hashes(wrong)) / math.log(2)
    shards = 1 if bits <= most_bits else math.ceil(bits / (0.75 * most_bits))
    for number in range(shards):
        mine = in_shard(F.col("key"), Shard(number, shards))
        yield Shard(number, shards), _levels(inside.where(mine), outside.where(mine), wrong)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule whose host is the url's or above it and whose path begins the url's, as a struct; else null."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...], blocked: DataFrame, url: str = "url", key: str = "page_id",
               most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict. `blocked` has domains in a column `key`.

    A rule's verdict comes first; else a host is blocked if it, or a domain above it, is listed. A null url and one without `://` have an empty host and
    path: no rule with a host fits, and they are allowed. Rows that repeat come back repeated; urls of any length are read whole; other columns are not read. No rules, no listed domains
    and an empty table are fine.
    """
    parts = pages.select(F.col(key).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    blocked = blocked.select(F.translate("key", _UPPER, _LOWER).alias("key")).where("key <> ''")
    depth = F.size(F.split("key", r"\.")).alias("depth")
    depths = sorted(r["depth"] for r in blocked.select(depth).distinct().collect())  # as many as a name may have labels
    domains = F.array(*[domain_at(F.col("host"), d) for d in depths]) if depths else F.array().cast("array<string>")
    universe = parts.select("host").distinct().select(F.explode(domains).alias("key"))
    marked = parts.withColumn("listed", F.lit(False))
    for shard, cascade in cascades_of(blocked, universe, most_bits):
        found = F.exists(domains, lambda d: in_shard(d, shard) & listed(d, cascade)) if cascade else F.lit(False)
        marked = marked.withColumn("listed", F.col("listed") | found)
        if shard.number < shard.of - 1:
            marked = write_shared(marked, "urls-marked")
    ruled = marked.withColumn("fitting", fitting_rule(F.col("host"), F.col("path"), rules))
    return ruled.select("page_id", "host", "path", F.col("fitting.name").alias("rule"),
                        F.coalesce("fitting.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
