import re
from collections import Counter

import corpus_pipeline
from ledgerloom.llm import pii, simhash
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.shared import table, write_shared

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "surrogates", "mixing"]
    docs = table(spark, SMALL, "documents")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(write_shared(stage(spark, kept[-1], SMALL), f"test-{name}"))
        assert kept[-1].columns == columns
    rows = [{r.doc_id: r for r in df.collect()} for df in kept]
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:]))

    scored = {r.doc_id for r in QUERIES["op7_compression_classifier"](spark, SMALL).where("predicted = 1").collect()}
    assert set(rows[1]) == scored

    prints = {i: simhash.fingerprint(r.text) % 2**64 for i, r in rows[1].items()}
    group = {i: i for i in prints}
    changed = True
    while changed:  # smallest id reachable, by brute force
        changed = False
        for a in prints:
            for b in prints:
                if group[b] < group[a] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    group[a], changed = group[b], True
    assert set(rows[2]) == {i for i in prints if group[i] == i}

    plain = lambda t: " ".join(["", *re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower()), ""])
    items = [plain(r.text) for r in table(spark, SMALL, "benchmark").collect()]
    holding = {i for i, r in rows[2].items() if any(x in plain(r.text) for x in items)}
    assert holding and not holding & set(rows[3])

    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        found = {e.canonical for e in pii.entities(rows[3][i].text)}
        assert not found & {e.canonical for e in pii.entities(r.text)} and r.n_chars == len(r.text)
        assert found or r.text == rows[3][i].text

    copies = Counter(r.doc_id for r in kept[5].collect())
    assert max(copies.values()) <= 2
    assert corpus_pipeline.run(spark, SMALL).count() == sum(copies.values())


def test_empty_documents_pass_all_stages(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = write_shared(stage(spark, docs, SMALL), f"empty-{name}")
        assert docs.count() == 0


def test_odd_rows_pass_all_stages(spark, odd_docs):
    """Near copies and exact ones go, each row that stays is a row that came, and rows without an id are not lost to the deduplication."""
    docs, ids = odd_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.collect()}
        docs = write_shared(stage(spark, docs, SMALL), f"odd-{name}")
        assert docs.columns == odd_docs.columns
        ids[name] = sorted(str(r.doc_id) for r in docs.collect())
        assert set(ids[name]) <= set(map(str, before))
    groups = {r.doc_id: r.component_id for r in simhash.simhash_groups(odd_docs.where("doc_id is not null")).collect()}
    good = set(ids["quality_classifier"])
    first = {}
    for i in sorted(x for x in groups if str(x) in good):
        first.setdefault(groups[i], str(i))
    assert [i for i in ids["near_dedup"] if i != "None"] == sorted(first.values())
    assert ids["near_dedup"].count("None") == ids["quality_classifier"].count("None")
    assert ids["surrogates"] == ids["decontamination"]
