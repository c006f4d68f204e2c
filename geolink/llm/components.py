"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches
from geolink.operators.staging import stage_table

#: Edges that a task holds before it contracts them.
HELD = 500_000


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars with the same components as the edges: each node but the smallest, and the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


class Contraction:
    """Gathers the edges of a task in bounded memory and gives them back as stars."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.size += len(a)

    def take(self, least: int = 1):
        """A batch of stars, if ``least`` edges are held."""
        if self.size >= least:
            a, b = (np.concatenate(side) for side in zip(*self.held, strict=True))
            self.held, self.size = [], 0
            high, low = contracted(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], names=["u", "v"])


def _contract(batches: Batches) -> Batches:
    held = Contraction()
    for batch in batches:
        held.add(*(batch[c].to_numpy(zero_copy_only=False) for c in ("u", "v")))
        yield from held.take(HELD)
    yield from held.take()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of an edge but the roots; a root is its component's smallest.

    Nodes are numbers of type long; loops and repeated edges do no harm. Each task first contracts
    its own edges. Then large-star and small-star steps alternate until nothing changes: each node
    is linked to the smallest of its neighbours, by a partial aggregate and a join in which the many
    edges of one node can be split. A round is staged as a table; two numbers reach the driver.
    """
    pairs = edges.select(
        F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
    ).filter("u > v")
    edges = stage_table(map_batches(pairs, _contract, "u bigint, v bigint").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(low, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = stage_table(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .filter("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = stage_table(small, "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
