import random

import numpy as np
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [words[k : k + 3] for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def roots(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def test_fingerprint_is_the_majority_of_shingle_bits(prose):
    for text in (None, "", " \t", "One", "one TWO", prose(5, 200), "É é A"):
        assert simhash.fingerprint(text) % 2**64 == brute_fingerprint(text)


def test_links_within_two_bits_join_groups(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(140):  # copies that drift by up to four bits
        x = rng.choice(prints)
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            x ^= 1 << bit
        prints.append(x)
    signed = [x - 2**64 if x >> 63 else x for x in dict.fromkeys(prints)]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {r.node: r.root for r in components(links).collect()}
    want = roots(len(signed), lambda a, b: int((signed[a] ^ signed[b]) % 2**64).bit_count() <= 2)
    for a in range(len(signed)):
        for b in range(a):
            assert (want[a] == want[b]) == (got.get(signed[a], signed[a]) == got.get(signed[b], signed[b]))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 141)} == {100} and {got[k] for k in range(200, 260)} == {7} and 5 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs):
    rows = simhash.simhash_groups(odd_docs).collect()
    assert len(rows) == 10
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    zero = "0" * 16
    assert by_id[2] == by_id[3] == by_id[5] == {(zero, 2)} and (zero, 2) in by_id[None]
    assert {c for _, c in by_id[1] | by_id[7]} == {1}
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "6", "None", "None"]
    assert simhash.simhash_groups(odd_docs.limit(0)).count() == 0


def test_a_large_group_of_near_copies_is_a_star(spark):
    base = 0x0123456789ABCDEF
    prints = [base ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(a)]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in prints], "fp long")).count()
    assert links <= 64 * len(prints)
    assert np.unique([r.root for r in components(simhash.near_links(spark.createDataFrame([(x,) for x in prints], "fp long"))).collect()]).size == 1


def test_one_document_of_each_group_stays(spark, prose):
    rng = random.Random(6)
    texts = []
    for k in range(40):
        words = prose(k, rng.randint(60, 400)).split()
        texts.append(" ".join(words))
        for share in (0.0, 0.002, 0.005, 0.04):
            copy = " ".join(f"new{rng.random()}" if rng.random() < share else w for w in words)
            texts.append(copy.upper() if rng.random() < 0.3 else copy)
    texts += ["one two", "One  two", "two one", "", None]
    prints = [simhash.fingerprint(t) % 2**64 for t in texts]
    want = roots(len(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = [r.doc_id for r in simhash.drop_near_duplicates(docs).collect()]
    assert sorted(kept) == sorted({min(i for i, w in enumerate(want) if w == g) for g in set(want)})


def test_an_id_on_different_texts_loses_none(spark, prose):
    rows = [(1, prose(1, 90), "a"), (2, prose(1, 90), "b"), (2, prose(2, 90), "c"), (2, prose(2, 90), "c"), (3, prose(3, 90), "d"), (3, prose(4, 90), "e"), (4, prose(4, 90), "f"),
            (5, prose(5, 90), "g"), (5, prose(5, 90), "h")]
    for order in (rows, rows[::-1]):
        kept = [tuple(r) for r in simhash.drop_near_duplicates(spark.createDataFrame(order, "doc_id long, text string, source string")).collect()]
        assert sorted(set(kept) - {rows[-1], rows[-2]}) == sorted({rows[0], rows[2], rows[4], rows[5]})
        assert len(kept) == 5 and sum(r[0] == 5 for r in kept) == 1
    assert len({r for r in kept if r[0] == 5}) == 1
