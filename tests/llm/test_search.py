import math
import re
from collections import Counter

import numpy as np
import pytest
from llm.edge_cases import LONG, TEXTS, clashing, documents, empty, prose

from geolink.llm import search

ITEM = "item_id bigint, text string, number int, terms string, rank int"
ITEMS = [
    (1, "same text HERE"),
    (2, None),
    (3, " ,.- "),
    (4, "a row without an id, a row"),
    (5, "漢字 ééé end nowhere"),
    (6, LONG),
    (4, "word"),
    (None, "here and here"),
    (7, "neither-of-these occurs!"),
    (8, prose(30)),
    (8, "a"),
    (8, "a"),
]
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k=10):
    """All scores of all documents, one by one."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    count = sum(1 for _, c in held if c)
    length = sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 100 - 90 + 90 * c.total() * count // max(length, 1)
            score = 0
            for t in set(terms(text)) & c.keys():
                weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                score += weight * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score:
                scores.append((-score, doc is None, doc))
        rows += [(item, n, s[2], -s[0]) for n, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=str)


def asked(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, 0, "x", 3) for i, t in items], ITEM)


def found(docs, items, **options):
    return sorted((tuple(r) for r in search.ranked(docs, items, **options).collect()), key=str)


@pytest.mark.parametrize("make", [documents, clashing])
def test_edge_cases(spark, make):
    expected = brute(TEXTS, ITEMS)
    assert len({r[0] for r in expected}) >= 6
    assert found(make(spark).repartition(3), asked(spark)) == expected


def test_small_blocks_of_documents_and_of_items(spark, monkeypatch):
    docs = [(i % 90, prose(5 + i % 40)) for i in range(300)] + [(500, "same words for all " * 3)] * 40
    items = [(i, t) for i, (_, t) in enumerate(docs[:40])] + [(99, "same words")]
    monkeypatch.setattr(search, "BLOCK_DOCS", 7)
    monkeypatch.setattr(search, "BLOCK_TERMS", 50)
    monkeypatch.setattr("geolink.llm.common.BATCH_ROWS", 5)
    table = documents(spark, docs).repartition(2)
    assert found(table, asked(spark, items), k=4) == brute(docs, items, 4)


def test_names_that_are_texts(spark):
    docs = documents(spark, [(i, t) for i, t in TEXTS if i]).selectExpr("cast(doc_id AS string) AS d", "text AS t")
    items = asked(spark).selectExpr("cast(item_id AS string) AS q", "text AS t")
    rows = search.ranked(docs, items, id_col="d", text_col="t", item_id_col="q", item_text_col="t")
    assert rows.columns == ["q", "rank", "d", "score"] and rows.count() > 20


def test_nothing_to_search(spark):
    assert found(empty(spark), asked(spark)) == []
    assert found(documents(spark), asked(spark, [])) == []


def test_accumulators_stop_and_scores_stay_exact():
    rng = np.random.default_rng(3)
    stopped = 0
    for _ in range(60):
        docs, vocabulary, k = 400, 40, 5
        share = np.r_[rng.uniform(0.005, 0.05, 20), rng.uniform(0.5, 1.0, 20)]
        present = rng.random((docs, vocabulary)) < share
        sizes = present.sum(axis=1)
        ids = np.nonzero(present)[1]
        tf = rng.integers(1, 4, len(ids))
        df = present.sum(axis=0)
        weights = np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)
        query = search.Query([0], [], weights, docs, int(tf.sum()))
        lengths = np.bincount(np.repeat(np.arange(docs), sizes), tf, docs).astype(np.int64)
        block = search.postings(query, sizes, lengths, ids, tf)
        item = np.array(sorted(rng.choice(vocabulary, 15, replace=False), key=lambda t: df[t]))
        full = np.zeros(docs, np.int64)
        for t in item:
            part = slice(block.starts[t], block.starts[t + 1])
            full[block.docs[part]] += block.parts[part]
        order = [d for d in np.lexsort((np.arange(docs), -full))[:k] if full[d]]
        for floor in (0, int(full[order[-1]])):
            at, scores = search.best(block, item, k, floor)
            assert sorted(order) == at.tolist() and (full[at] == scores).all()
        assert search.best(block, item, k, int(full.sum()))[0].tolist() == []
        # With all weight on rare terms, documents with frequent terms alone get no accumulator.
        stopped += int(np.count_nonzero(full) > len(search.best(block, item, docs, int(full[order[-1]]))[0]))
    assert stopped > 10
