import hashlib
import random
import re

from geolink.llm import decontam
from llm.edge_cases import DOCUMENT, PASSAGE, TEXTS, clashing, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "item_id bigint, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window):
    grams = {}
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + size]), set()).add(name)
    out = []
    for text in texts:
        w = words(text)
        hit, names = [False] * len(w), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if (g := tuple(w[i : i + size])) in grams:
                    hit[i : i + size] = [True] * size
                    names |= grams[g]
        digest = hashlib.sha256(",".join(sorted(str(n) for n in names if n is not None)).encode())
        named = len([n for n in names if n is not None])
        out.append((len(w), sum(hit), named, digest.hexdigest(), any(hit)))
    return out


def check(spark, texts, items, window=10):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENT)
    table = spark.createDataFrame(items, ITEM)
    found = decontam.contamination_digests(docs, table, window=window).collect()
    got = {r.doc_id: tuple(r)[1:] for r in found}
    assert [got[i] for i in range(len(texts))] == brute(texts, items, window)


def test_random_words(spark):
    rng = random.Random(3)

    def text(size):
        return " ".join(rng.choice("abc") for _ in range(rng.randint(0, size)))

    check(spark, [text(40) for _ in range(80)], [(i, text(9)) for i in range(12)], window=4)


def test_edge_cases(spark):
    items = [(1, PASSAGE), (2, None), (3, ""), (4, "same text"), (4, "here"), (5, PASSAGE.upper()), (None, "row")]
    check(spark, [t for _, t in TEXTS], items)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 50)
    monkeypatch.setattr(decontam, "KEPT", 2)
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(12))) for i in range(15)]
    texts = [" ".join(rng.choice("abcde") for _ in range(60)) for _ in range(20)]
    check(spark, texts, items, window=5)


def test_cutting_leaves_no_window_and_clean_texts_alone(spark):
    docs = clashing(spark)
    items = spark.createDataFrame([(1, PASSAGE), (2, "lorem ipsum")], ITEM)
    cut = decontam.decontaminate(docs, items, coverage=0.8)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert 10 not in texts and texts[2] is None
    assert texts[1] == dict(TEXTS)[1] and texts[12] == dict(TEXTS)[12]
    assert decontam.contamination(cut, items).filter("n_hit > 0").count() == 0


def test_parts_that_meet_after_a_cut_are_cut_too(spark):
    items = spark.createDataFrame([(1, "a b c d"), (2, "x y z q")], ITEM)
    docs = spark.createDataFrame([(1, "1 2 3 4 5 6 7 8 9 x y a b c d z q 10", None, None, None)], DOCUMENT)
    cut = decontam.decontaminate(docs, items, window=4, coverage=0.6).collect()
    assert words(cut[0].text) == [*"123456789", "10"]


def test_empty_tables(spark):
    items = spark.createDataFrame([], ITEM)
    assert decontam.contamination_digests(empty(spark), items).count() == 0
    check(spark, ["some words", None], [])
    docs = clashing(spark)
    assert decontam.decontaminate(docs, items).count() == docs.count()
