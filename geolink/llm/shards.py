"""Sharding by fixed virtual slots.

Each record is hashed into one of ``SLOTS`` virtual slots, for good. Bytes are added up per slot, and a
versioned map says which shard has which slot. A first map deals the slots out by size, largest first, to
the lightest shard. Rebalancing edits a map: it moves single slots from the heaviest shard to the
lightest for as long as that brings the two closer, and leaves the others where they are. The law that
holds is ``bytes``: shards of near equal size. One record is the grain; a record larger than a shard's
share cannot be divided.

Records of one shard are numbered without gaps. For that, slots are cut into buckets of bounded size by
more digits of the same hash; the number of a record is its rank in its bucket plus the sizes of the
buckets before it.

Everything is DataFrame expressions. Only the slot sizes, a fixed number of rows, meet the driver; the
map is broadcast, with one row for each slot.

Groups of equal texts are not kept together: their records go by their ids, so that a text which a third
of all records have is spread like any others, and only records that share an id, or a text without one,
are in one slot.

A record without an id is placed by its text; a null text has one byte, an empty text as well. Rows that
repeat are records of their own, in the same slot.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geolink.operators.staging import stage_table

#: Hexadecimal digits that name a slot, and the slots that there are.
DIGITS = 3
SLOTS = 16**DIGITS
#: Records that a bucket has on average, at most.
BUCKET = 20_000


def hash_digits(id_: Column, text: Column) -> Column:
    """The record's hash: of its id, or of its text if it has none."""
    return F.md5(F.coalesce(id_.cast("string"), F.concat(F.lit("text:"), text), F.lit("")))


def _slot(digits: Column) -> Column:
    return F.conv(F.substring(digits, 1, DIGITS), 16, 10).cast("int")


def first_map(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Slots to shards: the largest first, each to the lightest shard."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for slot in sorted(range(SLOTS), key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(loads)
        placed[slot] = shard
        heapq.heappush(loads, (load + sizes.get(slot, 0), shard))
    return placed


def rebalanced(placed: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """A map edited for new sizes or another number of shards; slots move only where it helps."""
    placed = dict(placed)
    loads = [0] * shards
    homeless = []
    for slot, shard in sorted(placed.items()):
        if shard < shards:
            loads[shard] += sizes.get(slot, 0)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        placed[slot] = loads.index(min(loads))
        loads[placed[slot]] += sizes.get(slot, 0)
    while True:
        high, low = loads.index(max(loads)), loads.index(min(loads))
        gap = loads[high] - loads[low]
        movable = [s for s, shard in placed.items() if shard == high and 0 < sizes.get(s, 0) < gap]
        if not movable:
            return placed
        best = min(movable, key=lambda s: (abs(2 * sizes.get(s, 0) - gap), s))
        placed[best] = low
        loads[high] -= sizes[best]
        loads[low] += sizes[best]


def map_table(spark: SparkSession, placed: dict[int, int], version: int) -> DataFrame:
    """One version of a map as a table: ``version, slot, shard``."""
    rows = [(version, slot, shard) for slot, shard in sorted(placed.items())]
    return spark.createDataFrame(rows, "version int, virtual_slot int, shard int")


def read_map(maps: DataFrame, version: int | None = None) -> dict[int, int]:
    """A version of a stored map, by default the latest."""
    wanted = maps.agg(F.max("version")).first()[0] if version is None else version
    return {r["virtual_slot"]: r["shard"] for r in maps.filter(F.col("version") == wanted).collect()}


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, digits, virtual_slot`` of each record, without its text."""
    text = F.col(f"`{text_col}`")
    records = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.coalesce(F.octet_length(text).cast("long"), F.lit(0)) + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        hash_digits(F.col(f"`{id_col}`"), text).alias("digits"),
    )
    return records.withColumn("virtual_slot", _slot(F.col("digits")))


def slot_sizes(records: DataFrame) -> dict[int, int]:
    """Bytes of each slot: as many rows as there are slots, at most."""
    return {r[0]: r[1] for r in records.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def numbered(records: DataFrame, by: str = "shard") -> DataFrame:
    """Records with ``slot``, their number within the shard, from 0 and without gaps."""
    count = records.count()
    digits = 0
    while count > BUCKET * SLOTS * 16**digits:
        digits += 1
    bucketed = records.withColumn("bucket", F.substring("digits", 1, DIGITS + digits))
    sizes = bucketed.groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("held"))
    before = W.partitionBy(by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = stage_table(
        sizes.select(by, "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset")),
        "offsets",
    )
    within = W.partitionBy(by, "bucket").orderBy("digits", "id", "text_crc32", "size")
    ranked = bucketed.withColumn("rank", F.row_number().over(within) - 1)
    return ranked.join(offsets, [by, "bucket"]).withColumn(
        "slot", (F.col("offset") + F.col("rank")).cast("long")
    )


def sharded(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    previous: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records with their shard and number, and the stored versions of the map.

    Version 1 is the first map, unless ``previous`` has versions; the last version is edited for
    the sizes at hand.
    """
    spark = docs.sparkSession
    records = stage_table(slotted(docs, id_col, text_col), "records")
    sizes = slot_sizes(records)
    if previous is None:
        previous = stage_table(map_table(spark, first_map(sizes, shards), 1), "shard-map")
    latest = previous.agg(F.max("version")).first()[0]
    edited = rebalanced(read_map(previous, latest), sizes, shards)
    maps = stage_table(previous.unionByName(map_table(spark, edited, latest + 1)), "shard-map")
    # One row for each of a fixed number of slots.
    current = F.broadcast(maps.filter(F.col("version") == latest + 1).select("virtual_slot", "shard"))
    placed = records.join(current, "virtual_slot")
    return numbered(placed), maps


def shard_table(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per record: id, size, checksum, law, shard and number."""
    placed, _ = sharded(docs, shards, id_col, text_col)
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
