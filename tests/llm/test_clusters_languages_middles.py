"""Clustering by ns-bounds, languages by cross-parsing, and fill-in-the-middle against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import cross_parsing, fill_middle, ns_clusters
from ledgerloom.llm.queries import ORACLE_SQL, QUERIES

# --- clusters


def plain_kmeans(vectors, order, k, rounds):
    """(cluster, distance) of each vector and the centroids, in Python integers, with every distance."""
    centroids = [list(vectors[i]) for i in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        found = [nearest(v)[1] for v in vectors]
        for j in range(len(centroids)):
            own = [v for v, f in zip(vectors, found) if f == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own)]
    return [nearest(v)[::-1] for v in vectors], centroids


@pytest.mark.parametrize("seed, spread, rounds", [(1, 3, 3), (2, 40, 12), (3, 4000, 8), (4, 0, 3)])
def test_bounds_change_nothing(seed, spread, rounds):
    rng = np.random.default_rng(seed)
    middles = rng.integers(-30, 30, (7, 5))
    v = middles[rng.integers(0, 7, 400)] + rng.integers(-spread, spread + 1, (400, 5))
    history, state, evaluated = [v[:9].copy()], None, 0
    for _ in range(rounds):
        state, n = ns_clusters.assign(v, state, history)
        evaluated += n
        means = history[-1].copy()
        for j in range(9):
            if (state[0] == j).any():
                means[j] = v[state[0] == j].sum(0) // (state[0] == j).sum()
        history.append(means)
    state, n = ns_clusters.assign(v, state, history, finish=True)
    want, centroids = plain_kmeans(v.tolist(), range(400), 9, rounds)
    assert list(zip(state[0].tolist(), state[1].tolist())) == want
    assert history[-1].tolist() == centroids
    if rounds > 3:
        assert evaluated + n < 0.8 * 9 * 400 * (rounds + 1)  # and they save work


def test_total_displacement_loosens_less_than_the_sum_of_drifts():
    """A centroid that comes back leaves the bound as it was."""
    v = np.array([[0, 0], [10, 0]])
    history = [np.array([[0, 0], [10, 0]])]
    state, _ = ns_clusters.assign(v, None, history)
    for c in ([[0, 0], [10, 9]], [[0, 0], [10, -9]]):
        history.append(np.array(c))
        state, _ = ns_clusters.assign(v, state, history)
    history.append(history[0])
    assert (state[4] == 0).any()  # some bounds are as old as the first round
    state, _ = ns_clusters.assign(v, state, history, finish=True)
    assert state[0].tolist() == [0, 1] and state[1].tolist() == [0, 0]


def embedded(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cluster int, distance int")


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 0.1, 64) + i % 5).tolist(), i, 1, 2) for i in range(60)]
    rows += [rows[3]] * 30 + [(None, rows[4][1], None, None, None)]
    bad = [[0.5] * 63, [0.5] * 65, None, [], [None] + [0.5] * 63, [float("nan")] + [0.5] * 63, [float("inf")] + [0.5] * 63, [3e38] * 64]
    table = embedded(spark, rows + [(100 + i, b, None, None, None) for i, b in enumerate(bad)])
    got = [tuple(r) for r in ns_clusters.clustered(table).collect()]
    vectors = [[int(np.floor(64 * float(np.float32(x)))) for x in r[1]] for r in rows]
    key = lambda i: (rows[i][0] is None, hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), vectors[i])
    want, centroids = plain_kmeans(vectors, sorted(range(len(rows)), key=key), 16, 3)
    inertia = [sum(d for c, d in want if c == j) for j in range(16)]
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    whole = [(r[0], c, d, inertia[c], sum(inertia), text[c]) for r, (c, d) in zip(rows, want)]
    assert sorted(got, key=repr) == sorted(whole, key=repr)
    few = ns_clusters.clustered(embedded(spark, rows[:3])).collect()
    assert {r.distance for r in few} == {0} and {r.cluster for r in few} == {0, 1, 2}
    empty = ns_clusters.clustered(table.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_largest_components_are_exact(spark):
    big = float(2**21 - 1)
    table = embedded(spark, [(i, [big if (i + j) % 2 else -big for j in range(64)], 0, 0, 0) for i in range(2)] * 9)
    rows = ns_clusters.clustered(table).collect()
    assert len(rows) == 18 and {r.distance for r in rows} == {0}


# --- languages


def greedy_phrases(text, reference):
    """Longest matches by substring search, starting anew at every stretch."""
    n = 0
    for k in range(0, len(text), cross_parsing.STRETCH):
        stretch, i = text[k : k + cross_parsing.STRETCH], 0
        while i < len(stretch):
            size = 1
            while i + size < len(stretch) and stretch[i : i + size + 1] in reference:
                size += 1
            i, n = i + size, n + 1
    return n


def test_automaton_holds_the_substrings():
    text = b"abcbcabxabcb"
    steps = cross_parsing.suffix_automaton(text)
    words, todo = set(), [(0, b"")]
    while todo:
        state, word = todo.pop()
        words.add(word)
        todo += [(to, word + bytes([c])) for c, to in steps[state].items()]
    assert words == {text[i:j] for i in range(len(text) + 1) for j in range(i, len(text) + 1)}
    assert len(steps) <= 2 * len(text)


def test_phrases_are_the_longest_matches(prose):
    rng = random.Random(4)
    references = [prose(1, 300).encode(), "żółć źle ".encode() * 3 + prose(2, 40).encode(), b"a"]
    texts = [prose(k, rng.randint(1, 700)) for k in range(20)] + ["", " ", "żółć", "zzz qqq", "a" * 2000, "é" * 700, prose(9, 5000)]
    parsers = [cross_parsing.Parser(r) for r in references]
    bits = cross_parsing.code_lengths(pa.array(texts, pa.large_string()), parsers)
    for row, text in zip(bits, texts):
        want = [greedy_phrases(text.encode(), r) * np.log2(len(r) + 1) for r in references]
        assert row.tolist() == pytest.approx(want)


def test_letters_only():
    clean = cross_parsing.letters_only(pa.array(["Ab1c, ÉÖ\n--ß", None, "12 .", "日本語-x"]))
    assert clean.to_pylist() == ["ab c éö ß", "", " ", "日本語 x"]


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = cross_parsing.languages(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(out) > 250
    assert np.mean([r.lang_pred == r.lang for r in out]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark, odd_docs):
    rows = cross_parsing.languages(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    learnt = {r.lang for r in odd_docs.where("doc_id is not null and lang is not null and text is not null").collect()}
    for r in rows:
        blank = r.doc_id in (2, 3, 5)
        assert (r.lang_pred == "und") == blank or r.doc_id is None
        assert r.lang_pred in learnt | {"und"} and (r.score == 0) == (r.lang_pred == "und")
    assert cross_parsing.languages(odd_docs.limit(0)).count() == 0
    nothing = odd_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in cross_parsing.languages(nothing).collect()} == {"und"}


def test_languages_learn_from_no_held_out_row(spark, prose):
    rows = [(i, prose(i, 50), "aa") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    changed = spark.createDataFrame([(i, "zz qq " * 40 if i % 2 else t, "bb") if __import__("zlib").crc32(str(i).encode()) % 3 == 1 else (i, t, x) for i, t, x in rows], docs.schema)
    assert cross_parsing.fit(docs) == cross_parsing.fit(changed) and cross_parsing.fit(docs) == cross_parsing.fit(docs.repartition(7))


def test_copies_count_once_and_contradictions_not_at_all(spark, prose):
    keys = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    rows = [(i, "the same text here" if k % 2 else prose(i, 8), "aa") for k, i in enumerate(keys[:60])] + [(i, "sowohl als auch", "aa" if k % 2 else "bb") for k, i in enumerate(keys[60:80])]
    rows += [(i, prose(i, 8).upper(), "bb") for i in keys[80:120]]
    learnt = dict(cross_parsing.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert set(learnt) == {"aa", "bb"} and learnt["aa"].count(b"the same text here") == 1
    assert not any(b"sowohl" in t for t in learnt.values())


def test_sample_is_bounded(spark, prose):
    docs = spark.createDataFrame([(i, prose(i, 3000), f"l{i % 5}") for i in range(60)], "doc_id long, text string, lang string")
    small = cross_parsing.Sampling(languages=3, letters=2000)
    learnt = cross_parsing.fit(docs, sampling=small)
    assert len(learnt) == 3 and all(len(t) <= 2000 for _, t in learnt)


# --- fill in the middle


def plain_rewrite(text, key, unit, rate=100, suffix_first=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if h4 % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = ["", None, "\n", "\n\n\n", "a", "a\n", "a\nb", "\na", "é\nżółć\n日本語", "🙂\n" * 5, "x <M> y\nz", "\r\n\r\n", "<P", "𝒳é\n" + "a" * 30 + "\ńb"]


@pytest.mark.parametrize("unit", ["line", "char"])
def test_rewriting_is_that_of_the_characters(spark, unit):
    rng = random.Random(6)
    texts = ODD + ["".join(rng.choice("ab\n\né日🙂 ") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["é\n" * 50_000]
    docs = spark.createDataFrame([(i if i % 50 else None, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, made int, draw1 int")
    for rate in (100, 60):
        out = fill_middle.with_middle(docs, "whole", unit=unit, rate=rate).select("doc_id", "text", "whole.*", fill_middle.restored(
            fill_middle.F.col("whole.output"), fill_middle.F.col("whole.form")).alias("back")).collect()
        for r in out:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_rewrite(r.text or "", r.doc_id, unit, rate)
            assert r.back == (r.text or "")
        assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_exceptions_convert_both_ways():
    text = "aé日🙂b🙂é"
    index = fill_middle.Exceptions.of(np.frombuffer(text.encode(), np.uint8))
    byte = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert index.bytes(np.arange(len(text) + 1)).tolist() == byte.tolist()
    assert index.chars(byte).tolist() == list(range(len(text) + 1))
    assert len(index.byte) == 5 and len(fill_middle.Exceptions.of(np.frombuffer(b"plain", np.uint8)).byte) == 0


def test_middles_of_odd_rows(spark, odd_docs):
    rows = fill_middle.middle_digests(odd_docs).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    texts = {r.doc_id: r.text or "" for r in odd_docs.where("doc_id is not null").collect()}
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id is not None:
            n, form, p, m, output = plain_rewrite(texts[r.doc_id], r.doc_id, "line")
            assert tuple(r) == (r.doc_id, n, form, p, m, sha(output), sha(texts[r.doc_id]))
    assert fill_middle.middle_digests(odd_docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fill_middle.with_middle(odd_docs, "x", unit="word")


@pytest.mark.parametrize("name", ["op11_ns_bounds_clustering", "op13_fill_in_middle"])
def test_new_queries_equal_their_sql(spark, name):
    from checks.compare import connect, rows_of

    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    res = connect("/root/testdata/sf0.001").execute(ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(res.fetchall(), columns)
