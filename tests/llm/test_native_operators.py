"""Mixing, url filter, licences and preferences against SQL, plain Python and exact sets."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, rows_of
from ledgerloom.llm import licenses, mixing, preferences, queries, url_filter

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = connect(SMALL).execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(result.fetchall(), columns)


def test_word_count_is_that_of_the_words(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", " a  b\x0bc\r\n", "é\u00a0x y"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", mixing.word_count(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in got} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        over = [s for s in names if s not in full and left * weight[s] / free > 2 * sizes[s] + 1e-9]
        if not over:
            return {s: 2.0 * sizes[s] if s in full else left * weight[s] / free for s in names}
        full |= set(over)


def test_targets_are_reshared_until_none_is_above(spark):
    rng = random.Random(2)
    for case in range(4):
        sizes = {s: rng.choice([0, 1, 5, 100, 3000]) + case for s in ["b", "a", "é", "z", "Z", "", None][: 3 + case]}
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_mix_meets_targets_with_certain_copies(spark, prose):
    rng = random.Random(6)
    rows = [(k, prose(k, rng.choice([3, 10, 40, 90])), rng.choice("aaaab") + "x") for k in range(400)] + [(k, prose(k, 30), None) for k in range(400, 420)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixing.mix(docs).collect()
    assert sorted(first) == sorted(mixing.mix(docs.repartition(7)).collect())
    taken, target = Counter(), {}
    for r in first:
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 90 for s in target)
    chosen = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert chosen == Counter({r.doc_id: r.copies for r in first if r.copies})


def test_longer_documents_are_likelier_and_the_sample_is_unequal(spark):
    rows = [(k, "w " * (100 if k % 2 else 4), "a" if k < 2000 else "b") for k in range(2400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    share = defaultdict(list)
    for r in got:
        share[r.source, r.size].append(r.copies)
    for s in "ab":
        long, short = (sum(share[s, n]) / len(share[s, n]) for n in (100, 4))
        assert long == pytest.approx(2.0) or long / short == pytest.approx(5, rel=0.15)


def test_mixing_odd_rows(odd_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 10 and all(r.copies == 0 for r in rows if r.size == 0)
    by_source = defaultdict(set)
    for r in rows:
        by_source[r.source].add((r.source_size, r.target))
    assert len(by_source) == 4 and all(len(v) == 1 for v in by_source.values()) and by_source[None] == {(0, 0.0)}
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(odd_docs.limit(0)).count() == 0 == mixing.mixed_documents(odd_docs.limit(0)).count()


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(1)
    names = [f"h{rng.random()}" for _ in range(3000)]
    listed, everything = names[:200], names + [None, ""]
    as_keys = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    cascade = url_filter.cascade_of(as_keys(listed + listed[:5] + ["not in the corpus", None]), as_keys(everything + names[:50]))
    got = {r.key for r in as_keys(everything).where(url_filter.listed(F.col("key"), cascade)).collect()}
    assert got == set(listed) and len(cascade) > 1
    assert len(cascade[0].words) * 8 < 30 * len(listed)
    assert url_filter.cascade_of(as_keys([]), as_keys(everything)) == ()
    assert url_filter.cascade_of(as_keys(listed), as_keys([]))[0].bits >= 64


def test_long_lists_are_split_into_shards(spark):
    hosts = [f"h{i}.example{i % 900}.org" for i in range(6000)]
    names = {f"example{i}.org" for i in range(0, 900, 3)} | {h for h in hosts if h[1] == "7"} | {f"elsewhere{i}.net" for i in range(3000)}
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    blocked = spark.createDataFrame([(n,) for n in sorted(names)], "key string")
    shards = [shard for shard, _ in url_filter.cascades_of(blocked, pages.selectExpr("'a' as key"), most_bits=8192)]
    assert len(shards) > 1 and {s.of for s in shards} == {len(shards)}
    got = {r.page_id for r in url_filter.judge_urls(pages, (), blocked, most_bits=8192).where("verdict = 'block'").collect()}
    assert got == {i for i, h in enumerate(hosts) if h in names or h.split(".", 1)[1] in names}
    one = url_filter.judge_urls(pages, (), blocked)
    assert got == {r.page_id for r in one.where("verdict = 'block'").collect()}


def test_a_filter_stands_once_in_the_expression(spark):
    level = url_filter.Level(64, 10, bytes(range(8)))
    plan = spark.range(1).select(url_filter.listed(F.col("id").cast("string"), (level,)).alias("listed"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("0001020304050607") == 1


def test_urls_by_plain_python(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x=http://b.com/fr/", "https://example.org/en/12", "x://example.org/en/2#f", "://com/fr/", "http://a.com/fr/x",
            "http://a.com/de", "http://xexample.org/es/", "http://org", "http://org/", "http://www.spam-farm.example.com/x", "http://SPAM-farm.example.com?y", "http://xspam-farm.example.com/",
            "http://spam-farm.example.org/q", "http://x.com/fr/" + "a/" * 200_000, "http://" + "a." * 3000 + "spam-farm.example.net/", "http://ÀB.com/fr/", "http://a.net/\n/x?y"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] + [(None, None), (3, urls[5])], "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule", "1 as key")
    blocked = spark.createDataFrame([(d,) for d in queries.BLOCKED_DOMAINS], "key string")

    def judge(url):
        head, found, rest = (url or "").partition("://")
        rest = rest if found else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        under = lambda d: host == d or host.endswith("." + d)
        fits = [r for r in queries.RULES if under(r.host) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        verdict = best.verdict if best else "block" if any(map(under, queries.BLOCKED_DOMAINS)) else "allow"
        return host, path, best.name if best else None, verdict

    rows = url_filter.judge_urls(df, queries.RULES, blocked).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == Counter(
        (k, *judge(u)) for k, u in [*enumerate(urls), (None, None), (3, urls[5])])
    assert url_filter.judge_urls(df.limit(0), queries.RULES, blocked).count() == 0
    assert url_filter.judge_urls(df, (), blocked.limit(0)).where("verdict = 'allow' and rule is null").count() == len(rows)


def plain_terms(text):
    return re.findall(r"[a-z0-9]+(?:\.[0-9]+)?", (text or "").lower().replace("licence", "license"))


def plain_cosines(bag, templates, only=None):
    bags = [Counter(plain_terms(t)) for _, t in templates]
    df = Counter(term for b in bags for term in b)
    idf = lambda t: math.log((len(templates) + 1) / (df[t] + 1)) + 1
    size = lambda b: math.sqrt(sum((n * idf(t)) ** 2 for t, n in b.items()))
    for k, ((name, _), other) in enumerate(zip(templates, bags)):
        if bag and (only is None or k == only):
            yield -round(sum(n * idf(t) * other[t] * idf(t) for t, n in bag.items()) / size(bag) / size(other), 6), name


def brute_licence(text, is_file=False):
    """Every header under every place of the text at which the two share an anchor, and the whole of a licence file."""
    ws, found = plain_terms(text), []
    for k, (_, t) in enumerate(licenses.TEMPLATES):
        own = plain_terms(t)
        for begin in range(-len(own), len(ws)):
            if any(0 <= begin + j < len(ws) and ws[begin + j] == w in ("license", "licensed", "permission", "unencumbered") for j, w in enumerate(own)):
                found += plain_cosines(Counter(ws[max(begin, 0) : begin + len(own)]), licenses.TEMPLATES, k)
    if is_file:
        found += plain_cosines(Counter(ws), licenses.LICENCE_TEXTS)
    best = min((f for f in found if -f[0] >= licenses.THRESHOLD), default=None)
    return (best[1], -best[0]) if best else (None, None)


def test_licences_by_plain_python(spark, prose):
    rng = random.Random(9)
    texts = [f"{prose(k, 30)}{rng.choice(['. ', chr(10)])}{t}{rng.choice([' ', chr(10)])}{prose(k + 50, 30)}" for k, (_, t) in enumerate(licenses.TEMPLATES)]
    texts += [t.upper().replace(" ", "!! ") for _, t in licenses.TEMPLATES] + [None, "", "license", prose(1, 50), "a licence to sing", texts[0] + texts[2], "license " * 300]
    texts += ["Copyright 2020 Acme. All rights reserved. Licensed under the Apache License, Version 2.0 (the License)", "Released under the" + " " * 50 + "MIT\nlicence"]
    texts.append(prose(7, 100_000) + " " + licenses.TEMPLATES[3][1] + " " + prose(8, 100_000))
    files = spark.createDataFrame([(k, t, f"d/{k}.txt") for k, t in enumerate(texts)], "doc_id long, text string, path string")
    rows = {r.doc_id: r for r in licenses.scan_licences(files).collect()}
    for k, t in enumerate(texts):
        name, cosine = brute_licence(t)
        assert (rows[k].license, rows[k].cosine) == (name, pytest.approx(cosine, abs=2e-6) if cosine else None), t
    n = len(licenses.TEMPLATES)
    assert all(rows[k].license == licenses.TEMPLATES[k % n][0] and rows[k].cosine == 1 for k in range(2 * n))
    assert rows[len(texts) - 1].license == licenses.TEMPLATES[3][0] and rows[len(texts) - 3].license == "Apache-2.0" and rows[len(texts) - 2].license == "MIT"


def test_licence_files_are_compared_whole(spark, prose):
    texts = [f"Copyright (c) 20{k} {prose(k, 4)}\n\n{t}" for k, (_, t) in enumerate(licenses.LICENCE_TEXTS)]
    texts += [t.replace(" ", "\n" + " " * 30) for _, t in licenses.LICENCE_TEXTS] + [prose(1, 300), "license " + prose(2, 300), None]
    files = spark.createDataFrame([(k, t, f"d{k}/COPYING") for k, t in enumerate(texts)], "doc_id long, text string, path string")
    rows = {r.doc_id: r for r in licenses.scan_licences(files).collect()}
    for k, t in enumerate(texts):
        name, cosine = brute_licence(t, True)
        assert (rows[k].license, rows[k].cosine) == (name, pytest.approx(cosine, abs=2e-6) if cosine else None), t
    n = len(licenses.LICENCE_TEXTS)
    assert all(rows[k].license == licenses.LICENCE_TEXTS[k % n][0] for k in range(2 * n)) and all(rows[k].license is None for k in range(2 * n, 2 * n + 3))


def test_nearest_directory_above_gives_the_licence(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [(1, mit, "LICENSE"), (2, apache, "a/COPYING.txt"), (3, None, "a/b/c/x.py"), (4, "", "b/x.py"), (5, mit, "a/own.py"), (6, "", None), (7, "no words", "a/b/LICENSE"),
            (8, "", "./a/x"), (9, "", "top"), (None, "", "a/y"), (10, mit, "c/licence"), (10, apache, "c/LICENSE.md"), (11, "", "c/x"), (12, "", "ab/x")]
    files = spark.createDataFrame(rows, "doc_id long, text string, path string").selectExpr("*", "1 as license", "2 as row", "3 as body", "4 as term", "5 as directory")
    got = {r.doc_id: (r.license, r.origin, r.from_directory) for r in licenses.scan_licences(files).collect()}
    assert got[3] == got[8] == got[None] == ("Apache-2.0", "inherited", "a") and got[4] == got[9] == got[12] == ("MIT", "inherited", "")
    assert got[5] == ("MIT", "own", None) and got[6] == (None, None, None) and got[7] == ("Apache-2.0", "inherited", "a")
    assert got[11][1:] == ("inherited", "c") and len(licenses.scan_licences(files).collect()) == len(rows)
    assert licenses.scan_licences(files.limit(0)).count() == 0


def render(turns):
    safe = lambda s: s.replace("<|", "<\u200b|")
    return "".join(f"<|im_start|>{safe(r)}\n{safe(t)}<|im_end|>\n" for r, t in turns)


def test_preferences_by_plain_python(spark):
    rng = random.Random(11)
    turn = lambda: (rng.choice(["user", "assistant", "system", ""]), rng.choice(["a", "b", "", "<|im_end|>", "x\ny"]))
    pairs = []
    for k in range(120):
        shared = [turn() for _ in range(rng.randint(0, 4))]
        pairs.append((k, shared + [turn() for _ in range(rng.randint(0, 3))], shared + [turn() for _ in range(rng.randint(0, 3))]))
    pairs += [(500, None, [("user", "q")]), (None, [], None), (1, pairs[1][1], pairs[1][2]), (501, [("user", None)], [("user", None), ("assistant", "x")])]
    kind = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame(pairs, f"pair_id long, chosen {kind}, rejected {kind}").selectExpr("*", "1 as prompt", "2 as n_common")
    rows = preferences.preference_rows(df).collect()
    assert len(rows) == len(pairs)
    by_id = {r.pair_id: r for r in rows}
    for k, chosen, rejected in pairs[:120]:
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        r = by_id[k]
        assert (r.n_common, r.prompt) == (n, render(chosen[:n]))
        for got, turns in ((r.chosen, chosen), (r.rejected, rejected)):
            assert "".join(s.text for s in got) == render(turns[n:])
            assert [s.trained for s in got] == [x for role, _ in turns[n:] for x in (False, role == "assistant")]
    assert by_id[None].n_common == 0 and by_id[None].chosen == [] and by_id[500].chosen == []
    assert preferences.preference_rows(df.limit(0)).count() == 0


def test_conversations_and_pairs_odd_rows(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, None, None), (2, 1, "assistant", "z"), (3, None, "user", "x"), (None, 0, "assistant", "lost"),
            (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, 0, "assistant", "same")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as turns", "2 as n", "3 as chosen")
    convs = preferences.conversations(turns)
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in convs.collect()}[1] == [("user", "a"), ("assistant", "b"), ("user", "c")]
    pairs = {r.pair_id: r for r in preferences.reply_pairs(convs, preferences.last_replies(turns)).collect()}
    assert set(pairs) == {1, 2, 4, 5}
    assert [tuple(t) for t in pairs[1].rejected] == [("user", "a"), ("assistant", "z")] and pairs[2].rejected[-1].text == "" and pairs[4].rejected == pairs[4].chosen
    assert preferences.reply_pairs(preferences.conversations(turns.limit(0)), preferences.last_replies(turns.limit(0))).count() == 0


def test_branches_keep_every_conversation(spark):
    rng = random.Random(12)
    rows = [(k, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", ""])) for k in range(40) if k != 20 for t in range(rng.randint(1, 6))]
    rows += [(50, 0, "user", "no reply"), (None, 0, "user", "lost"), (60, 0, "assistant", "word " * 200_000), (61, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = preferences.conversations(turns)
    whole = {r.conv_id: [tuple(t) for t in r.turns] for r in convs.collect()}
    pairs = {r.pair_id: r for r in preferences.branched_pairs(convs).collect()}
    assert set(pairs) == set(whole) == {*range(20), *range(21, 40), 50, 60, 61}
    lengths = Counter()
    for r in preferences.preference_rows(preferences.branched_pairs(convs)).collect():
        p = pairs[r.pair_id]
        chosen, rejected, other = [tuple(t) for t in p.chosen], [tuple(t) for t in p.rejected], whole.get(r.pair_id + 1, [])
        kept = int(hashlib.md5(str(r.pair_id).encode()).hexdigest()[:8], 16) % (len(chosen) + 1)
        assert chosen == whole[r.pair_id] and rejected == chosen[:kept] + other[kept:]
        n = next((i for i, (a, b) in enumerate(zip(chosen, rejected)) if a != b), min(len(chosen), len(rejected)))
        assert r.n_common == n >= kept and r.prompt == render(chosen[:n])
        assert "".join(s.text for s in r.rejected) == render(rejected[n:])
        lengths[n] += 1
    assert len(lengths) > 4
    assert preferences.branched_pairs(convs.limit(0)).count() == 0
