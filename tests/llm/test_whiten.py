import math
from fractions import Fraction

import numpy as np
import pytest

from geolink.llm import queries, whiten
from geolink.llm.common import table

VECTOR = "vec_id bigint, embedding array<float>, label int, row int, component string, n string"
FOLDER = "/root/testdata/sf0.01"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "c", "n") for i, v in rows], VECTOR).repartition(3)


def brute(rows, wanted=4):
    """Whole numbers and fractions throughout, but for the eigenvectors."""
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    numbers = [(i, tuple(math.floor(256 * Fraction(c)) for c in v.tolist())) for i, v in usable]
    fit = sorted({x for _, x in numbers})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = [[Fraction(n * c - s, n) for c, s in zip(x, sums, strict=True)] for x in fit]
    size = len(sums)
    v = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(size)] for i in range(size)])
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:wanted]
    out = {}
    for i, x in numbers:
        own = [n * c - s for c, s in zip(x, sums, strict=True)]
        deviation = sum(c * c for c in own)
        white = (np.array([float(Fraction(c, n)) for c in own]) @ axes[:, order]) / np.sqrt(values[order])
        out.setdefault(i, []).append((deviation, white, values[order] / np.trace(v)))
    return n, out


def check(found, rows):
    n, expected = brute(rows)
    size = min(4, len(next(v for _, v in rows if v)))
    assert len(found) == sum(map(len, expected.values())) * size
    sign = {}
    for r in found:
        deviation, white, explained = expected[r.vec_id][0]
        k = r.component - 1
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained[k], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(white[k]), abs=1e-7)
        if abs(white[k]) > 1e-6:
            sign.setdefault(k, set()).add(math.copysign(1, r.whitened * white[k]))
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in sign.values())


def spread(seed, size, count=150):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(count, size)) * np.linspace(3, 0.5, size) + 1
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    return rows + [(1000 + i, v) for i, v in rows[:20]]


@pytest.mark.parametrize("size", [2, 5, 64])
def test_against_brute_force(spark, size):
    rows = spread(size, size)
    check(whiten.whitened(vectors(spark, rows)).collect(), rows)


def test_several_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(whiten, "TILE", 3)
    monkeypatch.setattr(whiten, "BLOCK", 64)
    rows = spread(9, 8)
    check(whiten.whitened(vectors(spark, rows)).collect(), rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(-1, None), (-2, []), (-3, [nan, 1.0]), (-4, [inf, 1.0]), (-5, [None, 1.0]), (None, [0.5, -0.0]), (-6, [-0.001, 0.0])]
    rows = spread(4, 2) + odd
    check(whiten.whitened(vectors(spark, rows)).collect(), rows)
    longer = [*rows, (-7, [1.0, 2.0, 3.0])]
    found = whiten.whitened(vectors(spark, longer)).collect()
    check(found, rows)
    assert -7 not in {r.vec_id for r in found}


def test_no_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        result = whiten.whitened(vectors(spark, rows))
        assert result.count() == 0 and result.columns[:2] == ["vec_id", "component"]
    flat = whiten.whitened(vectors(spark, [(i, [float(i), 7.0, 7.0]) for i in range(5)])).collect()
    assert {r.component for r in flat} == {1} and {r.explained for r in flat} == {1.0}


def test_numbers_of_many_bits(spark):
    rows = [(i, [float(2**k) * (i % 7 - 3), 1.0 * i, 0.25 * (i % 3)]) for i, k in enumerate([40] * 50)]
    found = whiten.whitened(vectors(spark, rows)).collect()
    n, expected = brute(rows)
    for r in found:
        deviation = expected[r.vec_id][0][0]
        assert r.deviation == (deviation if deviation < 2**63 else None)
    huge = whiten.whitened(vectors(spark, [(i, [1e38 * (i % 2), float(i)]) for i in range(10)])).collect()
    assert len(huge) == 20 or {r.component for r in huge} == {1}


def test_bit_planes():
    rng = np.random.default_rng(1)
    for count, bits in ((1, 1), (64, 3), (130, 20), (70, 33)):
        x = rng.integers(0, 2**bits, (count, 5)).astype(np.uint64)
        sliced = whiten.planes(x, bits)
        whole = x.astype(object)
        limbs = whiten.tile_limbs(sliced[:3], sliced[3:])
        product = sum(int(1 << (whiten.LIMB * k)) * limb.astype(object) for k, limb in enumerate(limbs))
        assert (product == whole[:, :3].T @ whole[:, 3:]).all()
        sums = sum(int(1 << (whiten.LIMB * k)) * limb.astype(object) for k, limb in enumerate(whiten.sum_limbs(sliced)))
        assert (sums == whole.sum(axis=0)).all()


def test_query_over_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, FOLDER, "embeddings").collect()]
    check(queries.queries()["op12_embedding_whitening"](spark, FOLDER).collect(), rows)
