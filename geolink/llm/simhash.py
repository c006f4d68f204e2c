"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint of 64 bits is linked to those that differ in at most four. It is cut into four segments
of 16 bits. A segment, padded to 23 bits, is decoded in the binary Golay code [23, 12, 7], itself and
with each of its bits flipped: one to six codewords, and segments that differ in at most two bits
have one in common, that of the word between them.

Four errors over four segments leave one of two cases:

* A segment is free of errors. Then there is one whose successor, in the circle of segments, has at
  most two. Keys: each segment as it is, with each codeword of the next (28 bits).
* Every segment has one error. Keys: each pair of codewords of the first two segments, with either
  half of the third, one of which is free of errors (32 bits). Here it is enough if one side is
  filed under the codewords of its own segments, and the other looks for all of its nearby ones.

Distinct fingerprints that share a key, under which one of them is filed, are compared and verified
by their distance. Equal fingerprints are one node from the start, however many documents have them.
Keys that one node has alone end there; the holders of a frequent key are dealt out to pairs of
blocks, so that each group is bounded and each two meet. A task gives back stars, not pairs.

A text of no words has the fingerprint zero and is linked like any other; null counts as no words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import KEY, KEY_TYPES, Batches, keyed_texts, map_batches, packed, unpacked
from geolink.llm.components import HELD, Contraction, connected_components
from geolink.operators.staging import stage_table

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Generator polynomial of the binary Golay code (fixed value).
GENERATOR = 0b110001110101
#: Fingerprints of one key that are compared in one group, at most about twice so many.
BLOCK = 2048


_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, by counts of their bytes."""
    planes = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    return (np.bincount(planes.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = bit_counts(hashes)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 hashes of a text's word shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(len(words) - shingle + 1, 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    starts = stops - sizes
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, count, 65536):
        begin = starts[low : min(low + 65536, count)]
        end = stops[low + shingle - 1 : low + shingle - 1 + len(begin)] if len(words) >= shingle else stops[-1:]
        hashes = np.array(
            [digest(joined[i:j], SEED) for i, j in zip(begin.tolist(), end.tolist(), strict=True)],
            np.uint64,
        )
        ones += bit_counts(hashes)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def with_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``id, text_id, text_version, fp``: each row's id and key, and its fingerprint as a long."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch["text"].to_pylist()]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *[batch[c] for c in KEY], fp], names=["id", *KEY, "fp"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    texts = keyed_texts(docs, id_col, text_col, F.col(f"`{id_col}`").alias("id"))
    return map_batches(texts, run, f"id {kind}, {KEY_TYPES}, fp bigint")


@lru_cache(1)
def _leaders() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each word of 23 bits, and the lightest word with each remainder."""
    words = np.arange(1 << 23, dtype=np.uint32)
    remainder = words.copy()
    for bit in range(22, 10, -1):
        high = (remainder >> np.uint32(bit)) & np.uint32(1)
        remainder ^= high * np.uint32(GENERATOR << (bit - 11))
    light = words[np.bitwise_count(words) <= 3]
    leader = np.zeros(1 << 11, np.uint32)
    leader[remainder[light]] = light
    return remainder.astype(np.uint16), leader


def near_codewords(words: np.ndarray) -> np.ndarray:
    """For each word of 23 bits the indices of its nearby codewords, filled up with -1.

    They are what the word, first, and those with one bit flipped decode to. An index is the
    codeword's leading twelve bits.
    """
    remainder, leader = _leaders()
    flips = np.array([0, *(1 << i for i in range(23))], np.uint32)
    near = words.astype(np.uint32)[:, None] ^ flips
    found = ((near ^ leader[remainder[near]]) >> np.uint32(11)).astype(np.int64)
    others = np.sort(found[:, 1:], axis=1)
    again = others == found[:, :1]
    again[:, 1:] |= others[:, 1:] == others[:, :-1]
    others = np.sort(np.where(again, 1 << 12, others), axis=1)[:, :5]
    return np.concatenate([found[:, :1], np.where(others < 1 << 12, others, -1)], axis=1)


@lru_cache(1)
def codewords() -> np.ndarray:
    """``near_codewords`` of all segments of 16 bits."""
    return near_codewords(np.arange(1 << 16))


def _pairs_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """All pairs of codeword indices of two segments, in 24 bits; -1 where there is none.

    The first pair is that of the words' own codewords.
    """
    a, b = first[:, :, None], second[:, None, :]
    return np.where((a >= 0) & (b >= 0), (a << 12) | b, -1).reshape(len(first), -1)


def keys_of(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of fingerprints: the position of the fingerprint, the key, and whether it is filed there."""
    table = codewords()
    segments = [
        ((fingerprints.view(np.uint64) >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64)
        for i in range(4)
    ]
    codes = [table[s] for s in segments]
    all_keys, filed = [], []
    for i in range(4):
        code = codes[(i + 1) % 4]
        key = (i << 32) | (segments[i][:, None] << 12) | code
        all_keys.append(np.where(code >= 0, key, -1))
        filed.append(np.ones(code.shape, bool))
    pairs = _pairs_of(codes[0], codes[1])
    for half in range(2):
        part = (segments[2] >> (8 * half)) & 0xFF
        all_keys.append(np.where(pairs >= 0, ((4 + half) << 32) | (part[:, None] << 24) | pairs, -1))
        filed.append(np.arange(pairs.shape[1]) == np.zeros((len(pairs), 1)))
    return _listed(all_keys, filed)


def _listed(keys: list[np.ndarray], filed: list[np.ndarray]):
    keys, filed = np.concatenate(keys, axis=1), np.concatenate(filed, axis=1)
    at, column = np.nonzero(keys >= 0)
    return at, keys[at, column], filed[at, column]


_KEYS = "key bigint, node bigint, filed boolean"


def _key_rows(node: np.ndarray, at: np.ndarray, keys: np.ndarray, filed: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(keys), pa.array(node[at]), pa.array(filed)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "node", "filed"])


def _keys(batches: Batches) -> Batches:
    for batch in batches:
        fp = batch["fp"].to_numpy(zero_copy_only=False)
        yield _key_rows(fp, *keys_of(fp))


def _close_pairs(bits: list[np.ndarray], group: np.ndarray, distance: int):
    """Positions of the pairs within sorted groups that differ in few enough bits."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    longest = int(np.diff(np.r_[starts, len(group)]).max())
    left = np.arange(len(group))
    found_a, found_b = [left[:0]], [left[:0]]
    for lag in range(1, longest):
        left = left[left + lag < len(group)]
        left = left[group[left + lag] == group[left]]
        apart = sum(np.bitwise_count(b[left] ^ b[left + lag]).astype(np.int64) for b in bits)
        found_a.append(left[apart <= distance])
        found_b.append(found_a[-1] + lag)
    return np.concatenate(found_a), np.concatenate(found_b)


def _within(columns: list[str], distance: int):
    """Finds the pairs of nodes that share a group and differ in few enough bits."""

    def find(rows: dict[str, np.ndarray], group: np.ndarray):
        a, b = _close_pairs([rows[c].view(np.uint64) for c in columns], group, distance)
        return rows["node"][a], rows["node"][b]

    return find


def _compare(find, rows: int = 100_000):
    """Stars of the links that ``find`` verifies in rows that are sorted by group."""

    def run(batches: Batches) -> Batches:
        stars = Contraction()
        parts: list[pa.RecordBatch] = []

        def compare(last: bool) -> None:
            if not parts:
                return
            held = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            changes = np.zeros(len(held), bool)
            for c in ("key", "low", "high"):
                values = held[c].to_numpy(zero_copy_only=False)
                changes[1:] |= values[1:] != values[:-1]
            group = np.cumsum(changes)
            # The last group may go on in the next batch.
            end = len(held) if last else int(np.searchsorted(group, group[-1]))
            parts[:] = [held.slice(end)] if end < len(held) else []
            if end:
                names = [c for c in held.schema.names if c not in ("key", "low", "high")]
                part = {c: held[c].to_numpy(zero_copy_only=False)[:end] for c in names}
                a, b = find(part, group[:end])
                if len(a):
                    stars.add(a, b)

        for batch in batches:
            if batch.num_rows:
                parts.append(batch)
            if sum(p.num_rows for p in parts) >= rows:
                compare(False)
                yield from stars.take(HELD)
        compare(True)
        yield from stars.take()

    return run


def shared_keys(keys: DataFrame, block: int = BLOCK) -> DataFrame:
    """``key, low, high, node``: the groups of nodes that meet under a key.

    A key counts if two have it and one is ``filed`` there. Holders of a frequent key are dealt to
    blocks, and each pair of blocks is a group.
    """
    shared = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("holders"), F.bool_or("filed").alias("any_filed")
    )
    shared = shared.filter("holders > 1 AND any_filed").select("key", "holders")
    return (
        # A merge join at every size, in which the rows of a frequent key can be split.
        keys.join(stage_table(shared, "keys").hint("merge"), "key")
        .withColumn("blocks", F.ceil(F.col("holders") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "node",
        )
    )


def links_within_groups(groups: DataFrame, find) -> DataFrame:
    """``u, v``: stars that connect the ``node``s that share a group and that ``find`` links."""
    order = ["key", "low", "high"]
    dealt = groups.repartition(*order).sortWithinPartitions(*order)
    return map_batches(dealt, _compare(find), "u bigint, v bigint")


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """``u, v``: stars that connect the distinct fingerprints ``fp`` within the distance."""
    if distance > DISTANCE:
        raise ValueError(f"the keys find distances up to {DISTANCE}")
    keys = map_batches(distinct.select("fp"), _keys, _KEYS)
    return links_within_groups(shared_keys(keys, block), _within(["node"], distance))


def _grouped(rows: DataFrame, distance: int) -> DataFrame:
    """Rows with ``component_id``, the smallest id of the rows whose fingerprints are connected, and ``root``.

    The root is the component's smallest fingerprint. It tells components apart where ids are null or
    repeated.
    """
    classes = stage_table(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    roots = connected_components(fingerprint_links(classes, distance), "u", "v")
    rooted = classes.join(roots, classes["fp"] == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """Per row: ``id``, its key, ``fp``, ``root``, and ``component_id``, the smallest id in reach by links.

    Repeated rows get one result each. A null id is never the smallest unless there is no other.
    """
    rows = stage_table(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return _grouped(rows, distance)


def component_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``fingerprint`` as 16 hexadecimal digits, and ``component_id``."""
    return near_groups(docs, id_col, text_col).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """The rows and columns of ``docs``, of each group of near copies the row with the smallest id.

    Rows that repeat an id and text of the group count once; of them the one with the smallest hash of its
    other columns stays. Groups without ids, or that share one, are kept apart. Texts without words are
    one group.
    """
    groups = near_groups(docs, id_col, text_col, shingle, distance)
    keepers = (
        groups.filter(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct(*KEY)).alias("one"))
        .select("one.text_id", "one.text_version")
    )
    texts = keyed_texts(docs, id_col, text_col, packed(docs, text_col))
    kept = texts.join(keepers, KEY, "left_semi").groupBy(*KEY).agg(
        F.min_by(F.struct("row", F.col("text").cast("string").alias("body")), F.xxhash64(F.to_json("row"))).alias("one")
    )
    return unpacked(kept.select("one.row", "one.body"), docs, text_col, "body")
