"""Ranked lexical search: term at a time, with limited accumulators.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. N counts
the documents with a term, L all their terms, n those of one document, df the documents that hold a term,
tf its occurrences in one. All but the weight's logarithm is integer arithmetic, divisions rounding down:

    weight = floor(1000 ln((2 N + 2) / (2 df + 1)))
    score  = sum of weight * (10**9 tf / (1000 tf + 8 m)),  m = 10 + 90 n N / L

The documents are read once for each block of items: of each one the counts of the block's terms are kept,
as a staged table. A task then searches its documents in blocks. For each item it takes the terms rarest
first. While a document with none of the terms so far could still be among the best ``k``, each document
that holds the term gets an accumulator. Once the largest parts that the remaining terms have in this block
add up to less than the kth partial score, or than the kth score that the task has found for the item
before, no accumulator is created any more, and the frequent terms only update those that there are, all
of them and exactly. The best ``k`` of each task and item meet in one ranking.

Items come in blocks of about ``BLOCK_TERMS`` distinct terms (an item is not divided), each of which visits
the driver and is broadcast; the number of blocks has no bound. Documents are never collected.

A null text has no terms, nor has one without letters and digits: such a document is not found, such an
item has no rows. Equal scores go by ascending id, null ids last. Repeated documents are found each, and
repeated items are answered each.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from heapq import nsmallest
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches
from geolink.llm.decontam import words
from geolink.operators.staging import stage_table

#: Rows that an item gets.
TOP = 10
#: Distinct terms of items in one block, about.
BLOCK_TERMS = 200_000
#: Documents and postings that a task searches at once, at least, unless it has no more.
BLOCK_DOCS = 32_768
BLOCK_POSTINGS = 4_000_000


class Query(NamedTuple):
    """Items of one block: their numbers and their terms' ids, rarest first; and what terms weigh."""

    numbers: list[int]
    terms: list[np.ndarray]
    weights: np.ndarray
    docs: int
    length: int


class Postings(NamedTuple):
    """Documents by term, in their order, with what the term adds to their score, and the most it adds."""

    starts: np.ndarray
    docs: np.ndarray
    parts: np.ndarray
    most: np.ndarray
    count: int


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Items with a ``number``, their distinct ``terms`` and the ``block`` that they are searched with."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            terms = [sorted(set(words(t))) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(terms, pa.list_(pa.binary()))], names=["row", "terms"]
            )

    df = items.select(
        F.struct(F.col(f"`{id_col}`")).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )
    kind = df.schema["row"].dataType.simpleString()
    found = map_batches(df, run, f"row {kind}, terms array<binary>").filter(F.size("terms") > 0)
    placed = stage_table(found.withColumn("number", F.monotonically_increasing_id()), "items")
    total = placed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS) or 1
    return placed.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks))), blocks


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Per row: the id in ``row``, its number of terms ``n``, and counts ``tf`` of the ``terms`` asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Batches) -> Batches:
        known = shared.value.get
        for batch in batches:
            sizes, ends, terms, counts = [], [0], [], []
            for text in batch["text"].to_pylist():
                found = words(text)
                held = Counter(map(known, found))
                held.pop(None, None)
                sizes.append(len(found))
                terms += held.keys()
                counts += held.values()
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, counts)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(sizes, pa.int64()), *lists], names=["row", "n", "terms", "tf"]
            )

    df = docs.select(
        F.struct(F.col(f"`{id_col}`").alias("id")).alias("row"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )
    kind = df.schema["row"].dataType.simpleString()
    schema = f"row {kind}, n bigint, terms array<int>, tf array<int>"
    return stage_table(map_batches(df, run, schema), "term-counts")


def make_query(items: list, counts: DataFrame, vocabulary: dict[bytes, int]) -> Query:
    """The statistics of all documents, and the items' terms ordered by them."""
    total = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    docs, length = total[0], total[1] or 0
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in held.toLocalIterator():
        df[term] = n
    weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in df.tolist()]
    terms = [np.array(sorted((vocabulary[t] for t in i.terms), key=lambda t: (df[t], t))) for i in items]
    return Query([i.number for i in items], terms, np.array(weights, np.int64), docs, length)


def postings(query: Query, sizes: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> Postings:
    """The documents of a block by term; ``lengths`` are numbers of terms, ``sizes`` of postings."""
    # Beyond 64 bits Python's integers take over.
    wide = 90 * query.docs * int(lengths.max(initial=0)) >= 2**63
    long = lengths.astype(object) if wide else lengths
    m = (10 + 90 * query.docs * long // max(query.length, 1)).astype(np.int64)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(terms, kind="stable")
    docs, terms, tf = docs[order], terms[order], tf[order].astype(np.int64)
    parts = query.weights[terms] * (10**9 * tf // (1000 * tf + 8 * m[docs]))
    starts = np.searchsorted(terms, np.arange(len(query.weights) + 1))
    most = np.zeros(len(query.weights), np.int64)
    held = np.flatnonzero(np.diff(starts))
    if len(held):
        most[held] = np.maximum.reduceat(parts, starts[held])
    return Postings(starts, docs, parts, most, len(sizes))


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best(block: Postings, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of the block and their scores, earlier ones first among equals.

    ``floor`` is a score that ``k`` documents elsewhere have at least: what stays below may be left out.
    """
    bounds = block.most[terms].tolist()
    left, done, held = sum(bounds), 0, None
    scores = np.zeros(block.count, np.int64)
    for term, most in zip(terms.tolist(), bounds, strict=True):
        if held is None and left < max(floor, done):
            # A new document could reach ``left`` at most. It is late if k documents have more.
            if left < max(floor, _kth(scores, k)):
                held = np.flatnonzero(scores)
                if not len(held):
                    break
        part = slice(block.starts[term], block.starts[term + 1])
        docs, parts = block.docs[part], block.parts[part]
        if held is None:
            scores[docs] += parts
        elif len(docs) and len(held) * 16 < len(docs):
            at = np.minimum(np.searchsorted(docs, held), len(docs) - 1)
            hit = docs[at] == held
            scores[held[hit]] += parts[at[hit]]
        elif len(docs):
            alive = np.zeros(block.count, bool)
            alive[held] = True
            hit = alive[docs]
            scores[docs[hit]] += parts[hit]
        left -= most
        done += most
    found = np.flatnonzero(scores)
    if len(found) > k:
        worst = _kth(scores[found], k)
        above = found[scores[found] > worst]
        ties = found[scores[found] == worst][: k - len(above)]
        found = np.sort(np.r_[above, ties])
    return found, scores[found]


def _rank_key(entry: tuple) -> tuple:
    score, name = entry
    return (-score, name is None, name if name is not None else 0)


def best_of_tasks(counts: DataFrame, query: Query, k: int) -> DataFrame:
    """``number, row, score``: each task's best documents of each item."""
    shared = counts.sparkSession.sparkContext.broadcast(query)
    kind = counts.schema["row"].dataType.simpleString()

    def search(held: list[pa.RecordBatch], tops: list[list[tuple]], own: Query) -> None:
        rows = pa.Table.from_batches(held).combine_chunks()
        names = pc.struct_field(rows["row"].combine_chunks(), "id")
        # In the order of the ids, so that position decides among equal scores.
        order = pc.sort_indices(names, null_placement="at_end")
        rows, names = rows.take(order).combine_chunks(), names.take(order)
        terms, tf = (rows[c].combine_chunks() for c in ("terms", "tf"))
        sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (terms, tf)]
        block = postings(own, sizes, rows["n"].to_numpy(), *flat)
        for top, item in zip(tops, own.terms, strict=True):
            floor = top[k - 1][0] if len(top) >= k else 0
            found, scores = best(block, item, k, floor)
            if len(found):
                new = zip(scores.tolist(), names.take(pa.array(found)).to_pylist(), strict=True)
                top[:] = nsmallest(k, [*top, *new], key=_rank_key)

    def run(batches: Batches) -> Batches:
        own = shared.value
        tops: list[list[tuple]] = [[] for _ in own.terms]
        held, docs, size, names = [], 0, 0, None
        for batch in batches:
            names = batch["row"].type
            held.append(batch)
            docs += batch.num_rows
            size += len(batch["terms"].flatten())
            if docs >= BLOCK_DOCS or size >= BLOCK_POSTINGS:
                search(held, tops, own)
                held, docs, size = [], 0, 0
        if held:
            search(held, tops, own)
        if names is None:
            return
        for first in range(0, len(tops), 1000):
            part = range(first, min(first + 1000, len(tops)))
            rows = [(own.numbers[i], {"id": name}, score) for i in part for score, name in tops[i]]
            number, row, score = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(row, names), pa.array(score, pa.int64())],
                names=["number", "row", "score"],
            )

    return map_batches(counts, run, f"number bigint, row {kind}, score bigint")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: the item's id, ``rank``, the document's id, ``score``."""
    asked, blocks = item_terms(items, item_id_col, item_text_col)
    found = []
    for block in range(blocks):
        rows = asked.filter(F.col("block") == block).select("number", "terms").collect()
        names = sorted({t for r in rows for t in r.terms})
        vocabulary = {bytes(t): i for i, t in enumerate(names)}
        counts = term_counts(docs, vocabulary, id_col, text_col)
        found.append(best_of_tasks(counts, make_query(rows, counts, vocabulary), k))
    by_score = W.partitionBy("number").orderBy(F.desc("score"), F.col("row.id").asc_nulls_last())
    top = reduce(DataFrame.unionAll, found).withColumn("place", F.row_number().over(by_score))
    return (
        top.filter(F.col("place") <= k)
        .join(asked.select("number", F.col("row").alias("item")), "number")
        .select(
            F.col(f"item.`{item_id_col}`").alias(item_id_col),
            F.col("place").alias("rank"),
            F.col("row.id").alias(id_col),
            "score",
        )
    )
