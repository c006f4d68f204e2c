import random
from collections import Counter

import numpy as np
import pytest
from llm.edge_cases import DOCUMENT, TEXTS, clashing, documents, empty, prose

from geolink.llm import langid, queries, toxicity
from geolink.llm.common import table

FOLDER = "/root/testdata/sf0.1"
LABEL = "doc_id bigint, quality int, toxic int"


def insulting(rng):
    words = prose(60).split()
    for _ in range(4):
        words[rng.randrange(60)] = rng.choice(["idiot", "scum", "moron", "trash"])
    return " ".join(words)


def labelled(spark, count=300):
    rng = random.Random(1)
    texts = [(i, insulting(rng) if i % 4 == 0 else prose(60)) for i in range(count)]
    labels = [(i, 0 if i % 8 == 0 else 1, int(i % 4 == 0)) for i in range(count)]
    return documents(spark, texts), spark.createDataFrame(labels, LABEL)


def test_grades_are_ordered_and_share_weights(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    rows = toxicity.severities(docs, model).collect()
    assert all((r.doc_id % 4 == 0) == r.rejected for r in rows)
    assert all(0 <= r.severity <= 2 and (r.severity > 0.5) == (r.doc_id % 4 == 0) for r in rows)


def test_held_out_accuracy_of_toxicity(spark):
    docs, labels = (table(spark, FOLDER, t) for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.filter("doc_id % 3 <> 0"))
    scored = toxicity.severities(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id")
    rows = scored.select("toxic", "rejected").collect()
    caught = [r.rejected for r in rows if r.toxic == 1]
    clean = [r.rejected for r in rows if r.toxic == 0]
    assert np.mean(caught) > 0.9 and np.mean(clean) < 0.01


def test_toxicity_edge_cases(spark):
    docs, labels = labelled(spark)
    labels = labels.unionByName(
        spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 0), (2, 0, 0), (999, 0, 1)], LABEL)
    )
    model = toxicity.train(docs, labels)
    odd = clashing(spark, [*TEXTS, (50, "idiot scum moron trash"), (51, "scum " * 50 + prose(5000))])
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(TEXTS) and 50 not in ids and 51 not in ids
    assert toxicity.severities(empty(spark), model).count() == 0


def test_length_does_not_matter(spark):
    """Toxic passages in much clean text are caught, and clean texts of that length stay."""
    docs, labels = (table(spark, FOLDER, t) for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.filter("doc_id % 3 <> 0"))
    held = docs.join(labels.filter("doc_id % 3 = 0"), "doc_id").select("toxic", "text").orderBy("doc_id").collect()
    scored = [(r.toxic, r.text.encode(), model.above(np.array([model.score(r.text.encode())]))[0, 0]) for r in held]
    short = [p >= toxicity.LIMIT for toxic, t, p in scored if toxic and len(t) < 1000]
    # Some labelled toxic have none of the words: a text of 115 characters that is a license line, lists.
    assert np.mean(short) > 0.8
    sure = [t for toxic, t, p in scored if toxic and p > 0.5][:40]
    clean = [t for toxic, t, p in scored if not toxic and p < toxicity.LIMIT and len(t) < 5000]
    rng = random.Random(8)
    for size in (2_000, 5_000, 20_000, 300_000):
        caught, kept = [], []
        for passage in sure[: 40 if size < 100_000 else 15]:
            around = b" ".join(rng.choices(clean, k=size // 200))[:size]
            for text, out in ((passage + b" " + around, caught), (around + b" " + passage, caught), (around, kept)):
                out.append(model.above(np.array([model.score(text)]))[0, 0] >= toxicity.LIMIT)
        assert np.mean(caught) >= 0.9 and np.mean(kept) < 0.05, size


def slow_score(model, text):
    """The score of the worst section, one section after the other."""
    found, best, begin = toxicity.words(text), 0.0, 0
    while True:
        section = Counter(found[begin : begin + toxicity.SECTION])
        best = max(best, sum(min(n, 2) * model.weights.get(f, 0) for w, n in section.items() for f in toxicity.features_of(w)))
        if begin + toxicity.SECTION >= len(found):
            return best
        begin += toxicity.STEP


def test_scores_against_counting():
    rng = random.Random(4)
    model = toxicity.Model({b"idiot": 1.5, b"^idio": 0.5, b"^mor": 9.0, b"^moro": 1.0, b"scum": 2.0}, (1.0, 2.0))
    for count in (0, 1, 59, 60, 61, 80, 81, 100, 400):
        text = " ".join(rng.choice(["idiot", "idiots", "moron", "scum", *"abcdefghijklmnop"]) for _ in range(count))
        assert model.score(text.encode()) == pytest.approx(slow_score(model, text.encode()))
    assert model.score(None) == 0.0


def test_query_is_the_model_of_the_whole_table(spark):
    """All rows of the registered query, against the score one section at a time."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = {r.doc_id: r for r in queries.queries()["op7_toxicity"](spark, folder).collect()}
    for doc in docs.collect():
        above = model.above(np.array([slow_score(model, doc.text.encode() if doc.text else None)]))[0]
        r = rows[doc.doc_id]
        assert (r.severity, r.p_toxic) == pytest.approx((above.sum(), above[0]), abs=1e-9)
        assert r.rejected == (above[0] >= toxicity.LIMIT) and r.grade == (above >= 0.5).sum()


def test_a_labelled_id_of_many_texts_is_sampled(spark):
    texts = [(i % 3, insulting(random.Random(i)) if i % 3 == 0 else prose(30)) for i in range(60)] + [(1, "copy")] * 30
    labels = spark.createDataFrame([(i, 1, int(i == 0)) for i in range(3)], LABEL)
    rows = toxicity.sampled(documents(spark, texts), labels, "doc_id", "text", 25).collect()
    assert len(rows) == 25 and {r.grade for r in rows} == {0, 1}
    assert toxicity.sampled(documents(spark, texts), labels, "doc_id", "text", 900).count() == 61


def test_nothing_to_learn_from(spark):
    docs, labels = labelled(spark, 40)
    for given in (labels.limit(0), labels.filter("toxic = 0")):
        rows = toxicity.severities(docs, toxicity.train(docs, given)).collect()
        assert not any(r.rejected for r in rows)
    assert toxicity.train(empty(spark), labels).weights == {}


def test_held_out_accuracy_of_languages(spark):
    docs = table(spark, FOLDER, "documents")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    rows = rows.filter("lang_pred <> 'und'").select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def slow_presence(text):
    """Buckets by one n-gram at a time."""
    chars, found = [ord(c) for c in text.lower()], set()
    for i in range(len(chars)):
        code = 0
        for n in range(1, max(langid.ORDERS) + 1):
            if i + n > len(chars):
                break
            code = ((code ^ chars[i + n - 1]) * langid._MULTIPLIERS[n % 4]) & 0xFFFFFFFF
            code ^= code >> 15
            if n in langid.ORDERS:
                found.add(((code * (langid._MULTIPLIERS[0] + 2 * n)) & 0xFFFFFFFF) >> 17)
    return found


def test_presence_by_text_and_by_piece(monkeypatch):
    texts = [t or "" for _, t in TEXTS if not t or len(t) < 6000]
    whole = langid.presence(texts)
    assert [set(np.flatnonzero(r).tolist()) for r in whole] == [slow_presence(t) for t in texts]
    monkeypatch.setattr(langid, "PIECE", 50)
    assert (langid.presence(texts) == whole).all()


def test_language_edge_cases(spark):
    texts = [(i, f"der die das und {prose(9)}" if i % 2 else f"le la les des {prose(9)}") for i in range(60)]
    docs = clashing(spark, texts).selectExpr("*").drop("lang")
    docs = docs.selectExpr("*", "if(doc_id % 2 = 1, 'de', if(doc_id = 8, null, 'fr')) AS lang")
    model = langid.train(docs)
    assert model.languages == ("de", "fr")
    odd = clashing(spark)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == len(TEXTS)
    unknown = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert unknown == {2, 3, 4} and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.identify(empty(spark)).count() == 0
    nothing = langid.predict(odd, langid.train(empty(spark)))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_prediction_reads_the_text_alone(spark):
    docs = documents(spark)
    model = langid.train(table(spark, "/root/testdata/sf0.001", "documents"))
    other = spark.createDataFrame([(i, t, "zz", "q", 1) for i, t in TEXTS], DOCUMENT)
    a, b = (
        sorted(tuple(r)[2:] for r in langid.predict(d, model).collect()) for d in (docs, other)
    )
    assert a == b
