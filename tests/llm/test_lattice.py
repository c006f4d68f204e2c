import numpy as np
import pytest

from geolink.llm import lattice

VECTOR = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    usable = {}
    for k, (i, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            usable[k] = (i, np.array(v, np.float32).astype(np.float64))
    links = {k: set() for k in range(len(rows))}
    for a, (_, x) in usable.items():
        for b, (_, y) in usable.items():
            if a != b and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a].add(b)
    out = {}
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        out[rows[k][0]] = (len(links[k]), min(rows[n][0] for n in seen))
    return out


def clusters(seed, size=64, groups=25):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        x = rng.normal(size=size)
        for _ in range(rng.integers(1, 6)):
            rows.append((x + 0.05 * rng.normal(size=size)).astype(np.float32).tolist())
    rows += rows[:7]
    return [(i, v) for i, v in enumerate(rows)]


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTOR).repartition(3)
    result = lattice.near_vectors(table, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in result)
    return {r.vec_id: (r.n_links, r.component_id) for r in result}


@pytest.mark.parametrize("size", [64, 5, 1, 100])
def test_clusters(spark, size):
    rows = clusters(size, size) if size > 1 else [(i, [float(i - 2)]) for i in range(5)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize(("size", "noise"), [(64, 0.013), (64, 0.022), (16, 0.05), (3, 0.12), (2, 0.3)])
def test_groups_of_near_equal_vectors(spark, size, noise, monkeypatch):
    """Groups within a ball, and groups that lie across several, some beyond the threshold's reach.

    In cells so wide that all balls meet, every link is counted; in cells as they are, hardly one is missed.
    """
    monkeypatch.setattr(lattice, "BLOCK", 20)
    rng = np.random.default_rng(size)
    rows = []
    for count in (150, 60, 2, 1):
        x = rng.normal(size=size)
        x /= np.linalg.norm(x)
        rows += (x + noise * rng.normal(size=(count, size))).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(rows + rows[140:155])]
    expected = brute(rows)
    assert found(spark, rows, cell=50.0) == expected
    result = found(spark, rows)
    assert all(result[i][0] <= n for i, (n, _) in expected.items())
    assert sum(n for n, _ in result.values()) >= 0.98 * sum(n for n, _ in expected.values())
    assert {i for i, r in result.items() if r[1] != expected[i][1]} == set()


def test_balls_link_within_and_cells_hold_balls(spark):
    """A group of near-equal vectors is a few balls, and no table has a row for each of its pairs."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=64)
    rows = [(i, (x + 0.1 * rng.normal(size=64)).tolist()) for i in range(600)]
    table = spark.createDataFrame([(i, v, 1, i) for i, v in rows], "id bigint, embedding array<double>, rows bigint, first_id bigint")
    hashed = lattice.map_batches(table.select("id", "embedding"), lattice._nodes, "id bigint, node bigint, vector binary")
    nodes = hashed.selectExpr("node", "id as first_id", "1L as rows", "vector")
    members = lattice._gathered(nodes, 0.95, 10, 0.24).collect()
    assert len(members) == 600 and len({m.ball for m in members}) < 30
    by_ball = {}
    for m in members:
        by_ball.setdefault(m.ball, []).append(np.frombuffer(m.vector))
    for vectors in by_ball.values():
        unit = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
        assert (unit @ unit.T).min() >= 0.95


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0]), (11, [1.0, 0.0, 0.0]),
        (12, [1e-30, 0.0]), (13, [3e38, 1e37]),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == {}


def test_extra_columns_with_clashing_names(spark):
    names = "vec_id bigint, embedding array<float>, ball int, node string, rows int, centre int"
    table = spark.createDataFrame([(1, [1.0, 0.0], 5, "a", 2, 3), (2, [1.0, 0.1], 6, None, 2, 3)], names)
    assert {(r.vec_id, r.n_links, r.component_id) for r in lattice.near_vectors(table).collect()} == {(1, 1, 1), (2, 1, 1)}


def test_repeated_rows_link_to_each_other(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3 + [(None, [5.0, -1.0], 0)], VECTOR)
    rows = sorted((tuple(r) for r in lattice.near_vectors(table).collect()), key=str)
    assert rows == [(1, 2, 1, True)] * 3 + [(None, 0, None, True)]


def test_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 3
    point = lattice.nearest_e8(x) / 2
    roots = lattice.roots() / 2
    assert len(np.unique(roots, axis=0)) == 240 and np.allclose((roots**2).sum(axis=1), 2)
    own = ((x - point) ** 2).sum(axis=1)
    near = ((x[:, None] - point[:, None] - roots) ** 2).sum(axis=2)
    assert (near >= own[:, None] - 1e-9).all() and own.max() <= 1 + 1e-9


@pytest.mark.parametrize(("size", "count"), [(64, 1500), (8, 800), (16, 800), (768, 300)])
def test_recall_at_the_threshold(spark, size, count):
    """Pairs of exactly the least cosine, against brute force."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(count, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = 0.951
    z = c * x + np.sqrt(1 - c * c) * y
    rows = [(i, v) for i, v in enumerate(np.concatenate([x, z]).tolist())]
    result = found(spark, rows)
    cosine = x @ x.T
    assert np.sort(cosine, axis=1)[:, -2].max() < 0.95 or size < 16
    linked = sum(result[i + count][0] >= 1 for i in range(count))
    assert linked / count >= 0.9
