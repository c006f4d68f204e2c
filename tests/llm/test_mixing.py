import hashlib
import math
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from llm.edge_cases import TEXTS, clashing, documents, empty, prose

from geolink.llm import mixing



def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute(rows, weights=(3, 1, 2), share=Fraction(3, 2), epochs=2, seed=mixing.SEED):
    """``(doc_id, source, text)``: rows ``(doc_id, source, size, source_size, target, whole, taken)``."""
    held = defaultdict(list)
    for doc, source, text in rows:
        known = str(doc) if doc is not None else "text:" + text if text is not None else ""
        draw = hashlib.md5(f"{seed}:{known}".encode()).hexdigest()[: mixing.DIGITS]
        held[source].append((draw, doc, size(text)))
    names = sorted(held, key=lambda s: (s is None, s))
    total = {s: sum(d[2] for d in held[s]) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, clamped = share * sum(total.values()), set()
    while True:
        rest = budget - sum(epochs * total[s] for s in clamped)
        open_ = sum(weight[s] for s in names if s not in clamped)
        target = {s: epochs * total[s] if s in clamped else Fraction(rest * weight[s], open_) for s in names}
        over = {s for s in names if target[s] > epochs * total[s]}
        if not over:
            break
        clamped |= over
    out = []
    for s in names:
        whole, rest = divmod(math.floor(target[s] + Fraction(1, 2)), total[s]) if total[s] else (0, 0)
        upto = 0
        for draw in sorted({d[0] for d in held[s]}):
            same = [d for d in held[s] if d[0] == draw]
            words = sum(d[2] for d in same)
            for _, doc, n in same:
                more = n if upto + words <= rest else 0 if upto >= rest else n * (rest - upto) // words
                out.append((doc, s, n, total[s], float(target[s]), whole, n * whole + more))
            upto += words
    return sorted(out, key=str)


def plain(rows):
    return sorted(((*r[:4], pytest.approx(r[4]), *r[5:]) for r in rows), key=str)


def mixed(df, **options):
    return sorted((tuple(r) for r in mixing.mixed(df, **options).collect()), key=str)


def same(found, expected):
    assert [r[:4] + r[5:] for r in found] == [r[:4] + r[5:] for r in expected]
    assert [r[4] for r in found] == pytest.approx([r[4] for r in expected])


def sourced(spark, rows):
    shown = [(d, t, "en", s, 0) for d, s, t in rows]
    return spark.createDataFrame(shown, "doc_id bigint, text string, lang string, source string, n_chars int")


def many():
    names = ["a", "Ä", "b", None, "", "z", "\U0001f642", "￮"]
    rows = [(i, names[i % 7 if i % 5 else 0], prose(1 + i % 50)) for i in range(400)]
    return rows + [(900, "rare", prose(3)), (901, "none", None), (902, "none", " ")] + [(None, "a", "copy of a text")] * 60


def test_against_brute_force(spark):
    rows = many()
    found = mixed(sourced(spark, rows).repartition(3))
    same(found, brute(rows))
    # Small sources are at the cap, others share what is left of their parts.
    assert {r[5] for r in found} >= {0, 1, 2}


def test_words_come_near_the_target(spark):
    held = defaultdict(list)
    for _, s, n, _, target, _, taken in mixed(sourced(spark, many())):
        assert 0 <= taken <= 2 * n
        held[s].append((target, taken))
    for rows in held.values():
        assert abs(rows[0][0] - sum(t for _, t in rows)) <= 61
    total = sum(size(t) for _, _, t in many())
    assert sum(t for rows in held.values() for _, t in rows) == pytest.approx(1.5 * total, abs=70)


def test_one_document_is_taken_in_part(spark):
    rows = [(1, "a", prose(1001)), (2, "b", prose(500))]
    assert [r[6] for r in mixed(sourced(spark, rows))] == [1689, 563]


def test_edge_cases(spark):
    rows = [(i, "s", t) for i, t in TEXTS]
    same(mixed(clashing(spark).selectExpr("*", "1 AS draw", "2 AS held", "'x' AS edge", "0 AS whole")), brute(rows))
    same(mixed(documents(spark).withColumnRenamed("source", "kind"), source_col="kind"), brute([(i, "src0", t) for i, t in TEXTS]))
    assert mixed(empty(spark)) == []
    assert [r[6] for r in mixed(documents(spark, [(1, None), (2, "")]))] == [0, 0]


def test_given_weights_share_and_seed(spark):
    rows = [(i, "abc"[i % 3], prose(20)) for i in range(90)]
    docs = sourced(spark, rows)
    weights = spark.createDataFrame([("a", 1), ("b", 0)], "source string, weight int")
    found = mixed(docs, weights=weights, share=0.5, epochs=3, seed=1)
    target = {r[1]: r[4] for r in found}
    assert target == {"a": 900.0, "b": 0.0, "c": 0.0}
    other = mixed(docs, weights=weights, share=0.5, epochs=3, seed=2)
    assert found != other and found == mixed(docs.repartition(5), weights=weights, share=0.5, epochs=3, seed=1)
    assert mixed(docs, weights=weights, share=3.0, epochs=2)[0][4] == 1200.0
    assert {r[4] for r in mixed(docs, weights=weights.limit(0))} == {0.0}


def test_no_python_in_the_plan(spark, capsys):
    mixing.mixed(documents(spark)).explain("formatted")
    shown = capsys.readouterr().out
    assert "Python" not in shown and "Arrow" not in shown
