"""Embedding whitening by a bit-sliced scatter matrix.

Vectors are read as whole numbers, floor(256 c). The fit is over each distinct vector once. Its scatter matrix
is exact: each dimension is shifted by its smallest value, and its bits are packed across rows, one plane of
64-bit words for each bit. The sum over rows of x_i x_j is then the sum over pairs of planes of
2**(a + b) popcount(plane_ia AND plane_jb). Tasks do this in tiles of dimensions over bounded blocks of rows,
and add up tiles as 64-bit limbs, which a second step adds up over tasks. The driver gets one number for each
pair of dimensions, however many rows there are, centres them as integers, n sum(x_i x_j) - S_i S_j, and
takes the eigenvectors. Every row is then projected in one pass.

A vector that is null, or holds a null or an entry that is not finite, is left out, and so is one of another
length than most have (among equally frequent lengths the longer counts). Numbers beyond 64 bits are
taken as the nearest that there is. Components without variance have no rows, so a single vector, or an empty
table, has none. ``deviation`` is null where it would not fit 64 bits. Repeated rows count once in the fit and
have rows each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches
from geolink.operators.staging import stage_table

#: Steps of a unit.
SCALE = 256
#: Components that rows are projected on.
COMPONENTS = 4
#: Dimensions of a tile, rows of a block (a multiple of 64), bits of a limb.
TILE = 64
BLOCK = 8192
LIMB = 16


class Shape(NamedTuple):
    """The dimensions' smallest values and the bits of the widest range."""

    low: np.ndarray
    bits: int


class Fit(NamedTuple):
    """The fit: rows, shifted sums, and components as columns, already over the root of their variance."""

    shape: Shape
    count: int
    sums: np.ndarray
    axes: np.ndarray
    explained: np.ndarray


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Which rows are whole vectors; and by length the rows and their numbers."""
    sizes = np.where(column.is_null(), -1, column.value_lengths().fill_null(-1)).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(flat * SCALE)
    bad = ~np.isfinite(flat)
    scaled[bad] = 0
    # The nearest doubles within 64 bits.
    numbers = np.clip(scaled, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    ends = np.cumsum(np.maximum(sizes, 0))
    broken = np.r_[0, np.cumsum(bad)]
    starts = ends - np.maximum(sizes, 0)
    good = (sizes > 0) & (broken[ends] == broken[starts])
    found = {}
    for size in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == size))
        found[size] = (rows, numbers[starts[rows][:, None] + np.arange(size)])
    return good, found


def _vectors(df: DataFrame, vector_col: str, row: Column | None = None) -> DataFrame:
    vector = F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    return df.select(vector) if row is None else df.select(row, vector)


def shape_of(df: DataFrame, vector_col: str) -> Shape | None:
    """Ranges of the dimensions, for the most frequent length; as many numbers as a vector has."""

    def run(batches: Batches) -> Batches:
        seen: dict[int, list] = {}
        for batch in batches:
            for size, (rows, x) in whole_numbers(batch["vector"])[1].items():
                own = seen.setdefault(size, [0, x[0], x[0]])
                own[0] += len(rows)
                own[1] = np.minimum(own[1], x.min(axis=0))
                own[2] = np.maximum(own[2], x.max(axis=0))
        for size, (count, low, high) in seen.items():
            columns = [np.full(size, size), np.arange(size), np.full(size, count), low, high]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["size", "dim", "held", "low", "high"]
            )

    parts = map_batches(
        _vectors(df, vector_col), run, "size bigint, dim bigint, held bigint, low bigint, high bigint"
    )
    ranges = stage_table(
        parts.groupBy("size", "dim").agg(F.sum("held").alias("held"), F.min("low").alias("low"), F.max("high").alias("high")),
        "ranges",
    )
    most = ranges.filter("dim = 0").orderBy(F.desc("held"), F.desc("size")).first()
    if most is None:
        return None
    found = ranges.filter(F.col("size") == most["size"]).orderBy("dim").select("low", "high").collect()
    bits = max((high - low).bit_length() for low, high in found)
    return Shape(np.array([low for low, _ in found], np.int64), max(bits, 1))


def shifted(column: pa.Array, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the shape's length and their numbers above the smallest."""
    size = len(shape.low)
    none = (np.zeros(0, np.int64), np.zeros((0, size), np.int64))
    rows, x = whole_numbers(column)[1].get(size, none)
    return rows, x.view(np.uint64) - shape.low.view(np.uint64)


def distinct_vectors(df: DataFrame, vector_col: str, shape: Shape) -> DataFrame:
    """Each vector once, as shifted numbers in as few bytes as they need."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if shape.bits <= 8 * np.dtype(k).itemsize)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            _, x = shifted(batch["vector"], shape)
            x = np.unique(x, axis=0) if len(x) else x
            values = [r.tobytes() for r in x.astype(kind)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["x"])

    packed = map_batches(_vectors(df, vector_col), run, "x binary")
    return stage_table(packed.distinct(), "vectors"), kind


def _blocks(batches: Batches, kind: str, size: int) -> Iterator[np.ndarray]:
    """The vectors of a task in blocks of up to ``BLOCK`` rows."""
    held: list[np.ndarray] = []
    rows = 0
    for batch in batches:
        x = np.frombuffer(b"".join(batch["x"].to_pylist()), kind).reshape(-1, size)
        held.append(x)
        rows += len(x)
        while rows >= BLOCK:
            x = np.concatenate(held)
            yield x[:BLOCK]
            held, rows = [x[BLOCK:]], rows - BLOCK
    if rows:
        yield np.concatenate(held)


def planes(x: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of numbers (rows by dimensions) as words: dimension, bit, word."""
    count, size = x.shape
    out = np.zeros((size, bits, -(-count // 64) * 8), np.uint8)
    wide = np.ascontiguousarray(x.T).astype(np.uint64)
    for bit in range(bits):
        plane = np.packbits((wide >> np.uint64(bit) & np.uint64(1)).astype(bool), axis=1)
        out[:, bit, : plane.shape[1]] = plane
    return out.view(np.uint64)


def tile_limbs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cross-products of two tiles of planes in limbs: limb, dimension of a, dimension of b."""
    bits = a.shape[1]
    limbs = np.zeros((-(-(2 * bits - 1) // LIMB), len(a), len(b)), np.int64)
    for i in range(len(a)):
        for p in range(bits):
            counts = np.bitwise_count(b & a[i, p]).sum(axis=2, dtype=np.int64)
            for q in range(bits):
                limbs[(p + q) // LIMB, i] += counts[:, q] << ((p + q) % LIMB)
    return limbs


def sum_limbs(a: np.ndarray) -> np.ndarray:
    """Sums of the dimensions in limbs: limb, dimension."""
    bits = a.shape[1]
    limbs = np.zeros((-(-(2 * bits - 1) // LIMB), len(a)), np.int64)
    counts = np.bitwise_count(a).sum(axis=2, dtype=np.int64)
    for p in range(bits):
        limbs[p // LIMB] += counts[:, p] << (p % LIMB)
    return limbs


_LIMBS = "i int, j int, limbs binary"


def scatter(vectors: DataFrame, kind: str, shape: Shape) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sums and cross-products of the shifted numbers, as Python's integers.

    Tiles are named by their dimensions; the sums are tile (-1, -1), the number of rows is (-1, -2).
    """
    size, bits = len(shape.low), shape.bits
    firsts = range(0, size, TILE)

    def rows(totals: dict[tuple[int, int], np.ndarray]) -> Batches:
        for (i, j), limbs in totals.items():
            values = [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([limbs.tobytes()])]
            yield pa.RecordBatch.from_arrays(values, names=["i", "j", "limbs"])

    def add(totals: dict, at: tuple[int, int], limbs: np.ndarray) -> None:
        totals[at] = totals[at] + limbs if at in totals else limbs

    def count(batches: Batches) -> Batches:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for x in _blocks(batches, kind, size):
            sliced = planes(x, bits)
            add(totals, (-1, -2), np.array([len(x)], np.int64))
            add(totals, (-1, -1), sum_limbs(sliced))
            for i in firsts:
                for j in range(i, size, TILE):
                    add(totals, (i, j), tile_limbs(sliced[i : i + TILE], sliced[j : j + TILE]))
        yield from rows(totals)

    def total(batches: Batches) -> Batches:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, j, limbs in zip(*(batch[c].to_pylist() for c in ("i", "j", "limbs")), strict=True):
                add(totals, (i, j), np.frombuffer(limbs, np.int64))
        yield from rows(totals)

    parts = map_batches(vectors, count, _LIMBS).repartition("i", "j")
    found = {(r.i, r.j): np.frombuffer(r.limbs, np.int64) for r in map_batches(parts, total, _LIMBS).collect()}

    def whole(limbs: np.ndarray, *form: int) -> np.ndarray:
        weights = [1 << (LIMB * k) for k in range(limbs.size // int(np.prod(form)))]
        return sum(w * x for w, x in zip(weights, limbs.reshape(-1, *form).astype(object), strict=True))

    product = np.zeros((size, size), object)
    for i in firsts:
        for j in range(i, size, TILE):
            n, m = min(TILE, size - i), min(TILE, size - j)
            tile = whole(found[i, j], n, m)
            product[i : i + n, j : j + m] = tile
            product[j : j + m, i : i + n] = tile.T
    return int(found[-1, -2][0]), whole(found[-1, -1], size), product


def components(shape: Shape, count: int, sums: np.ndarray, product: np.ndarray, wanted: int) -> Fit:
    """Principal axes of the covariance, each over the root of its eigenvalue, by falling eigenvalue."""
    # n**2 times the covariance, exactly; division of integers rounds once.
    centred = count * product - np.outer(sums, sums)
    covariance = (centred / count**2).astype(np.float64)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(np.trace(centred) / count**2)
    least = max(float(values[0]), 0.0) * len(values) * np.finfo(np.float64).eps
    kept = int((values[:wanted] > least).sum())
    values, axes = values[:kept], axes[:, :kept]
    return Fit(shape, count, sums, axes / np.sqrt(values), values / trace if kept else values)


def _centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    """n x - S, exactly: 64-bit integers where they fit, else Python's."""
    high = (1 << fit.shape.bits) * fit.count
    if high < 2**62:
        return x.astype(np.int64) * fit.count - fit.sums.astype(np.int64)
    return x.astype(object) * fit.count - fit.sums


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Sums of squares, exactly; null beyond 64 bits."""
    about = (centred.astype(np.float64) ** 2).sum(axis=1)
    small = np.flatnonzero(about < 2.0**63 * 1.001)
    sums: list[int | None] = [None] * len(centred)
    # Here no entry is above 2**32, and no sum above 2**64.
    exact = np.abs(centred[small]).astype(np.uint64) ** np.uint64(2)
    for i, s in zip(small.tolist(), exact.sum(axis=1).tolist(), strict=True):
        sums[i] = s if s < 2**63 else None
    return sums


def _whitened(centred: np.ndarray, fit: Fit) -> np.ndarray:
    return (centred / fit.count).astype(np.float64) @ fit.axes


def identity_error(vectors: DataFrame, kind: str, fit: Fit) -> float:
    """Largest entry by which the covariance of the whitened fit vectors differs from the identity."""
    size, kept = len(fit.sums), fit.axes.shape[1]
    if not kept:
        return 0.0
    shared = vectors.sparkSession.sparkContext.broadcast(fit)

    def run(batches: Batches) -> Batches:
        own, total = shared.value, np.zeros((kept, kept))
        for x in _blocks(batches, kind, size):
            white = _whitened(_centred(x, own), own)
            total += white.T @ white
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(c.ravel()) for c in (i, j, total)], names=["i", "j", "v"])

    parts = map_batches(vectors, run, "i bigint, j bigint, v double")
    sums = parts.groupBy("i", "j").agg(F.sum("v").alias("v"))
    wrong = F.abs(F.col("v") / fit.count - (F.col("i") == F.col("j")).cast("double"))
    return sums.agg(F.max(wrong)).first()[0]


_RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(
    df: DataFrame,
    wanted: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row and component: the id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``."""
    spark = df.sparkSession
    row = F.struct(F.col(f"`{id_col}`")).alias("row")
    rows = _vectors(df, vector_col, row)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, {_RESULT}"
    shape = shape_of(df, vector_col)
    if shape is None:
        empty = spark.createDataFrame([], schema)
        return empty.select(F.col(f"row.`{id_col}`").alias(id_col), *empty.columns[1:])
    vectors, kind = distinct_vectors(df, vector_col, shape)
    fit = components(shape, *scatter(vectors, kind, shape), wanted)
    error = identity_error(vectors, kind, fit)
    shared = spark.sparkContext.broadcast(fit)

    def run(batches: Batches) -> Batches:
        own = shared.value
        kept = own.axes.shape[1]
        for batch in batches:
            places, x = shifted(batch["vector"], own.shape)
            centred = _centred(x, own)
            white = _whitened(centred, own) if len(x) else np.zeros((0, kept))
            deviations = np.repeat(np.array(_deviations(centred), object), kept)
            total = len(places) * kept
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"].take(pa.array(np.repeat(places, kept))),
                    pa.array(np.tile(np.arange(1, kept + 1), len(places)), pa.int32()),
                    pa.array(np.full(total, own.count), pa.int64()),
                    pa.array(deviations.tolist(), pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(own.explained, len(places))),
                    pa.array(np.full(total, error)),
                ],
                names=["row", *(f.split()[0] for f in _RESULT.split(", "))],
            )

    found = map_batches(rows, run, schema)
    return found.select(F.col(f"row.`{id_col}`").alias(id_col), *found.columns[1:])
