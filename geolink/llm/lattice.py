"""Embedding near-dedup by lattice hashing.

Unit vectors are projected to eight dimensions, in several tables of different random directions, and
decoded to the nearest point of the E8 lattice. Vectors that are close fall into the same cell of some
table, or into cells next to one another: each vector is filed under its own cell and looked up under
that and the nearest of the 240 neighbouring cells. What meets is verified by its cosine in double
precision, so that no link is below the threshold; the tables decide how many of the others are found.
``tests/llm`` measures the recall against brute force, at the threshold itself.

Equal vectors are one node from the start, however many rows have them, and count towards each
other's links. Vectors that share cells are gathered in balls: each joins the smallest node of one of its
cells that is verified to be within half the threshold's angle. All of a ball link with each other, by the
triangle inequality, and are counted, not paired. Cells then hold balls, so that a group of very many
near-equal vectors is a few entries. Two balls that meet are linked or not as wholes, where the angle
of their centres and their radii decide; else each vector of one is judged against the other ball, and
what is still open is compared in bounded blocks within tasks, which give back counts. No group's
pairs are ever rows, and a link of two balls is one edge for the components.

A vector that is null, of length zero, or holds a null or a number that is not finite has no links and is
its own component. Vectors of different length have no links. Rows that repeat an id are rows of
their own; the node that an id names has the links of all vectors of the id.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches
from geolink.llm.components import connected_components
from geolink.operators.staging import stage_table

THRESHOLD = 0.95
TABLES = 10
PROBES = 12
#: Up to so many dimensions there are twice as many tables: all of them see the whole distance of two
#: vectors, where projections of more dimensions are shorter in some tables.
FLAT = 12
#: Edge of a cell, against unit vectors whose projections keep their length on average.
CELL = 0.24
#: Vectors of a ball that are compared at a time, on average.
BLOCK = 128
#: Angles nearer than this to a bound are not decided by the triangle inequality.
MARGIN = 1e-6


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Twice the nearest point of E8, in whole numbers: the better of D8 and D8 plus one half."""

    def nearest_d8(y: np.ndarray) -> np.ndarray:
        whole = np.rint(y)
        gap = y - whole
        worst = np.abs(gap).argmax(axis=1)
        rows = np.arange(len(y))
        other = whole[rows, worst] + np.where(gap[rows, worst] >= 0, 1.0, -1.0)
        odd = whole.sum(axis=1) % 2 != 0
        whole[rows[odd], worst[odd]] = other[odd]
        return whole

    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], b, a)).astype(np.int64)


@lru_cache(1)
def roots() -> np.ndarray:
    """Twice the 240 shortest vectors of E8."""
    pairs = [
        tuple(2 * s if k == i else 2 * t if k == j else 0 for k in range(8))
        for i in range(8)
        for j in range(i + 1, 8)
        for s in (1, -1)
        for t in (1, -1)
    ]
    signs = [tuple(1 if m >> k & 1 else -1 for k in range(8)) for m in range(256)]
    return np.array(pairs + [s for s in signs if s.count(-1) % 2 == 0], np.int64)


@lru_cache(64)
def directions(table: int, size: int) -> np.ndarray:
    """Eight orthogonal directions of a table, scaled so that lengths are kept on average."""
    rng = np.random.default_rng([table, size])
    basis, _ = np.linalg.qr(rng.normal(size=(size, min(8, size))))
    basis = np.pad(basis, ((0, 0), (0, 8 - basis.shape[1])))
    return basis * np.sqrt(size / min(8, size))


def cells_of(unit: np.ndarray, table: int, cell: float, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each vector's own cell, and keys of the nearest neighbouring cells."""
    x = unit @ directions(table, unit.shape[1]) / cell
    point = nearest_e8(x)
    toward = (2 * x - point) @ roots().T
    chosen = np.argpartition(-toward, probes - 1, axis=1)[:, :probes] if probes else None
    own = _key(point, table, unit.shape[1])
    if chosen is None:
        return own, np.zeros((len(own), 0), np.int64)
    near = point[:, None, :] + roots()[chosen]
    return own, _key(near.reshape(-1, 8), table, unit.shape[1]).reshape(len(own), probes)


def _key(points: np.ndarray, table: int, size: int) -> np.ndarray:
    packed = np.ascontiguousarray(points.astype(np.int8)).view(np.uint64).ravel()
    x = (packed ^ np.uint64((table + 1) * 0x9E3779B97F4A7C15 + size & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _usable(values: list | None) -> np.ndarray | None:
    if not values or None in values:
        return None
    x = np.array(values, np.float64)
    return x if np.isfinite(x).all() and (x != 0).any() else None


def _nodes(batches: Batches) -> Batches:
    """The rows with a digest of their vector, and the vector in double precision; null if unusable."""
    for batch in batches:
        found = [_usable(v) for v in batch["embedding"].to_pylist()]
        node = [None if x is None else xxhash.xxh64_intdigest(x.tobytes()) - 2**63 for x in found]
        body = [None if x is None else x.tobytes() for x in found]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(node, pa.int64()), pa.array(body, pa.binary())],
            names=["id", "node", "vector"],
        )


def _unit(vectors: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Unit vectors by length, each with its positions."""
    by_size: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        by_size.setdefault(len(v) // 8, []).append(i)
    out = {}
    for size, at in by_size.items():
        x = np.frombuffer(b"".join(vectors[i] for i in at), np.float64).reshape(-1, size)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out[size] = np.array(at), x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def _cells(tables: int, probes: int, cell: float):
    """Distinct rows ``key, ball`` of a batch: the vectors' own cells and ``probes`` neighbours of each."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ball = batch["ball"].to_numpy(zero_copy_only=False)
            for at, unit in _unit(batch["vector"].to_pylist()).values():
                for table in range(tables if unit.shape[1] > FLAT else 2 * tables):
                    own, near = cells_of(unit, table, cell, probes)
                    keys = np.concatenate([own[:, None], near], axis=1)
                    pairs = np.stack([keys.ravel(), np.repeat(ball[at], keys.shape[1])], axis=1)
                    pairs = np.unique(pairs, axis=0) if len(set(ball[at].tolist())) < len(at) else pairs
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["key", "ball"]
                    )

    return run


def _cosines(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Cosine of each pair of vectors; -1 where their lengths differ."""
    out = np.full(len(a), -1.0)
    for size, (at, x) in _unit(a).items():
        same = np.array([len(b[i]) == 8 * size for i in at.tolist()])
        at, x = at[same], x[same]
        if len(at):
            (_, y), = _unit([b[i] for i in at.tolist()]).values()
            out[at] = np.einsum("ij,ij->i", x, y)
    return out


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def _near_centres(threshold: float):
    """Candidates within half the threshold's angle of a centre, with their angle."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            angle = _angles(_cosines(batch["a"].to_pylist(), batch["b"].to_pylist()))
            inside = pa.array(angle <= np.arccos(threshold) / 2 - MARGIN)
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["centre"], pa.array(angle)], names=["node", "centre", "angle"]
            ).filter(inside)

    return run


def _judged(cosines: np.ndarray, slack: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether all pairs around two points are links, and whether some may be; a point alone has no slack."""
    angle, most = _angles(cosines), np.arccos(threshold)
    point = slack == 0
    whole = np.where(point, cosines >= threshold, angle + slack <= most - MARGIN)
    return whole, whole | (~point & (angle - slack <= most + MARGIN))


def _judge(threshold: float, *kept: str):
    """Judges ``a`` against ``b`` with their ``slack``; keeps what may link and tells what links wholly."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            slack = batch["slack"].to_numpy(zero_copy_only=False)
            cosines = _cosines(batch["a"].to_pylist(), batch["b"].to_pylist())
            whole, some = _judged(cosines, slack, threshold)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(whole)], names=[*kept, "whole"]
            ).filter(pa.array(some))

    return run


def _compare(threshold: float):
    """Blocks of vectors against blocks of a ball: for each vector the rows that it links with."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                sides = [_unit([m["vector"] for m in row[side]]) for side in ("these", "those")]
                rows = np.array([m["rows"] for m in row["those"]], np.int64)
                names, counts = [], []
                for size in sides[0].keys() & sides[1].keys():
                    (at, x), (other, y) = (side[size] for side in sides)
                    names += [row["these"][i]["node"] for i in at.tolist()]
                    counts += ((x @ y.T >= threshold) @ rows[other]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array([row["ball"]] * len(names), pa.int64()),
                        pa.array([row["other"]] * len(names), pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["node", "ball", "other", "linked"],
                )

    return run


def _gathered(nodes: DataFrame, threshold: float, tables: int, cell: float) -> DataFrame:
    """``node, rows, first_id, vector`` with the ``ball`` of each node and its ``angle`` to the centre."""
    single = nodes.select(F.col("node").alias("ball"), "vector")
    own = stage_table(map_batches(single, _cells(tables, 0, cell), "key bigint, ball bigint"), "own-cells")
    least = own.groupBy("key").agg(F.min("ball").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    offered = own.join(least, "key").filter("ball <> centre").select(F.col("ball").alias("node"), "centre").distinct()
    a = nodes.select("node", F.col("vector").alias("a"))
    b = nodes.select(F.col("node").alias("centre"), F.col("vector").alias("b"))
    joined = offered.join(a, "node").join(b, "centre").select("node", "centre", "a", "b")
    near = map_batches(joined, _near_centres(threshold), "node bigint, centre bigint, angle double")
    chosen = near.groupBy("node").agg(F.min("centre").alias("centre"), F.min_by("angle", "centre").alias("angle"))
    return nodes.join(chosen, "node", "left").select(
        *nodes.columns, F.coalesce("centre", "node").alias("ball"), F.coalesce("angle", F.lit(0.0)).alias("angle")
    )


def _meetings(
    members: DataFrame, balls: DataFrame, threshold: float, tables: int, probes: int, cell: float
) -> DataFrame:
    """``u, v, whole``: balls that share a cell and have links, each pair once, or may have."""
    # A ball of one vector is in its cells once as it is; the others' entries are brought together first.
    vectors = stage_table(members.join(balls.select("ball", "lone"), "ball").select("ball", "lone", "vector"), "filed")

    def entries(count: int, name: str) -> DataFrame:
        alone, shared = (
            map_batches(vectors.filter(side), _cells(tables, count, cell), "key bigint, ball bigint")
            for side in ("lone", "not lone")
        )
        return alone.unionByName(shared.distinct()).withColumnRenamed("ball", name)

    met = entries(probes, "u").join(entries(0, "v"), "key")
    pairs = met.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    a, b = (
        balls.select(F.col("ball").alias(ball), F.col("centre").alias(side), F.col("radius").alias(f"r{side}"))
        for ball, side in (("u", "a"), ("v", "b"))
    )
    joined = pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b", (F.col("ra") + F.col("rb")).alias("slack"))
    return map_batches(joined, _judge(threshold, "u", "v"), "u bigint, v bigint, whole boolean")


def _compared(open_: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """``node, ball, other, linked``: the open cases ``node, ball, other``, vector by vector.

    Vectors are dealt to blocks by a hash of their node, as many as their number needs.
    """
    vectors = members.select("node", "rows", "vector", "ball")

    def dealt(df: DataFrame, *group: str) -> DataFrame:
        parts = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
        spread = df.join(parts, list(group)).withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
        block = F.collect_list(F.struct("node", "rows", "vector"))
        return spread.groupBy(*group, "part").agg(block.alias("block")).drop("part")

    these = dealt(open_.join(vectors, ["node", "ball"]), "ball", "other").withColumnRenamed("block", "these")
    named = open_.select(F.col("other").alias("ball")).distinct()
    those = dealt(vectors.join(named, "ball", "left_semi"), "ball")
    those = those.withColumnsRenamed({"ball": "other", "block": "those"})
    pairs = these.join(those, "other").select("ball", "other", "these", "those")
    kind = "node bigint, ball bigint, other bigint, linked bigint"
    return map_batches(pairs, _compare(threshold), kind).filter("linked > 0")


def ball_links(
    members: DataFrame, balls: DataFrame, threshold: float, tables: int, probes: int, cell: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links beyond the balls: edges ``u, v`` between balls, and numbers of rows ``linked`` by ball and by node."""
    met = stage_table(_meetings(members, balls, threshold, tables, probes, cell), "meetings")
    both = met.unionByName(met.select(F.col("v").alias("u"), F.col("u").alias("v"), "whole"))
    held = balls.select(F.col("ball").alias("v"), "held")
    of_ball = both.filter("whole").join(held, "v").groupBy(F.col("u").alias("ball")).agg(F.sum("held").alias("far"))
    # The vectors of a ball against the whole of another.
    single = members.select("node", F.col("ball").alias("u"), F.col("vector").alias("a"))
    target = balls.select(F.col("ball").alias("v"), F.col("centre").alias("b"), F.col("radius").alias("slack"))
    borders = both.filter("not whole").select("u", "v").join(single, "u").join(target, "v")
    borders = borders.select("node", F.col("u").alias("ball"), F.col("v").alias("other"), "a", "b", "slack")
    kind = "node bigint, ball bigint, other bigint, whole boolean"
    cases = stage_table(map_batches(borders, _judge(threshold, "node", "ball", "other"), kind), "borders")
    whole = cases.filter("whole").join(held.withColumnRenamed("v", "other"), "other")
    whole = whole.select("node", "ball", "other", F.col("held").alias("linked"))
    compared = _compared(cases.filter("not whole").drop("whole"), members, threshold)
    near = stage_table(whole.unionByName(compared), "border-links")
    of_node = near.groupBy("node").agg(F.sum("linked").alias("near"))
    across = near.select(F.col("ball").alias("u"), F.col("other").alias("v")).distinct()
    return met.filter("whole").select("u", "v").unionByName(across), of_ball, of_node


def near_vectors(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    cell: float = CELL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row: the id, ``n_links`` to other rows, ``component_id`` and whether it is ``kept``."""
    kind = embeddings.schema[id_col].dataType.simpleString()
    picked = embeddings.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("embedding")
    )
    rows = stage_table(
        map_batches(picked, _nodes, f"id {kind}, node bigint, vector binary"), "vectors"
    )
    usable = rows.filter("node is not null")
    nodes = stage_table(
        usable.groupBy("node").agg(
            F.min("id").alias("first_id"), F.count(F.lit(1)).alias("rows"), F.first("vector").alias("vector")
        ),
        "nodes",
    )
    members = stage_table(_gathered(nodes, threshold, tables, cell), "members")
    held = members.groupBy("ball").agg(
        F.sum("rows").alias("held"), F.max("angle").alias("radius"), (F.count(F.lit(1)) == 1).alias("lone")
    )
    centres = nodes.select(F.col("node").alias("ball"), F.col("vector").alias("centre"))
    balls = stage_table(held.join(centres, "ball"), "balls")
    links, of_ball, of_node = ball_links(members, balls, threshold, tables, probes, cell)
    roots_ = connected_components(links, "u", "v").select(F.col("node").alias("ball"), "root")
    rooted = members.groupBy("ball").agg(F.min("first_id").alias("first_id")).join(roots_, "ball", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "ball"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_ball = (
        rooted.join(least, "root")
        .join(balls.select("ball", "held"), "ball")
        .join(of_ball, "ball", "left")
        .select("ball", "component_id", (F.col("held") - 1 + F.coalesce("far", F.lit(0))).alias("far"))
    )
    found = stage_table(
        members.select("node", "ball")
        .join(of_ball, "ball")
        .join(of_node, "node", "left")
        .select("node", "component_id", (F.col("far") + F.coalesce("near", F.lit(0))).alias("n_links")),
        "found",
    )
    result = rows.select("id", "node").join(found, "node", "left")
    component = F.coalesce("component_id", "id")
    return result.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
