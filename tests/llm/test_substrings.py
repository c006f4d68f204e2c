import hashlib
import random
from collections import Counter

from geolink.llm import simhash, substrings
from llm.edge_cases import DOCUMENT, TEXTS, clashing, documents, empty, plain
from pyspark.sql import functions as F


def brute(texts, window):
    found = [(t or "").encode().split() for t in texts]
    counts = Counter(tuple(w[i : i + window]) for w in found for i in range(len(w) - window + 1))
    out = []
    for w in found:
        cut = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                cut[i : i + window] = [True] * window
        kept = b" ".join(x for x, c in zip(w, cut, strict=True) if not c)
        out.append((len(w), sum(cut), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, window=35, gram=8):
    docs = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENT
    ).repartition(3)
    found = {r.doc_id: tuple(r)[1:] for r in substrings.repeat_digests(docs, window, gram).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, window)


def test_random_texts_of_few_words(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    check(spark, texts, window=6, gram=2)


def test_edge_cases(spark):
    check(spark, [t for _, t in TEXTS])


def test_repeats_overlap_and_differ_in_length(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base[a : a + rng.randint(20, 90)]) for a in range(0, 250, 7)]
    check(spark, texts)


def test_repeat_within_one_text(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    check(spark, [f"{passage} between {passage} end", "a b c"])


def test_removal_keeps_rows_columns_and_clean_texts(spark):
    docs = clashing(spark)
    kept = substrings.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] == dict(TEXTS)[1] and texts[2] is None and texts[4] == "  \n\t "
    assert texts[5] == texts[6] == texts[10] == ""
    assert len(texts[9].split()) == 35


def test_rows_without_id_and_repeated_rows(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = documents(spark, [(None, passage), (None, passage), (1, "x " + passage), (1, "y"), (1, "y")])
    removed = plain(substrings.repeat_digests(docs).select("n_words", "n_removed"))
    assert removed == [(1, 0), (1, 0), (40, 40), (40, 40), (41, 40)]


def test_texts_without_id_whose_short_hashes_are_equal(spark):
    """Of 400,000 texts some have equal hashes of 32 bits; they are still different rows."""
    ids = spark.range(400_000).selectExpr("concat_ws(' ', transform(sequence(1, 62), k -> concat('w', k * 7919 % 97, 'x', id))) AS t")
    pairs = ids.groupBy(F.hash("t")).agg(F.collect_list("t").alias("ts")).filter("size(ts) > 1")
    a, b = pairs.orderBy(F.col("ts")[0]).first().ts[:2]
    rows = [(None, a), (None, b), (-1, b), (5, " ".join(a.split()[:40]))]
    texts = [t for _, t in rows]
    docs = documents(spark, rows).repartition(2)
    found = sorted(tuple(r)[1:] for r in substrings.repeat_digests(docs).collect())
    assert found == sorted(brute(texts, 35))
    kept = simhash.drop_near_copies(documents(spark, rows[:2]))
    assert sorted(r.text for r in kept.collect()) == sorted([a, b])


def test_ids_that_are_texts(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = documents(spark, [(1, passage), (2, "x " + passage), (3, "y")])
    docs = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    found = {r.doc_id: r.n_removed for r in substrings.repeat_digests(docs).collect()}
    assert found == {"d1": 40, "d2": 40, "d3": 0}


def test_empty_table(spark):
    assert substrings.repeat_digests(empty(spark)).count() == 0
    assert substrings.remove_repeats(empty(spark)).count() == 0
