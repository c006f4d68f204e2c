"""Substring dedup: seed and extend on winnowed anchors.

A window of ``window`` words is repeated when its word sequence also starts anywhere else, in the
same text or another. Every word inside a repeated window is removed, at all its places.

1. Seed. Each window names an anchor, the smallest hash among its runs of ``gram`` words; about one
   word in twelve is one. Anchors that occur once cannot lie in a repeated window and end here.
2. Extend. An anchor's windows form one span of words, the anchor extended both ways. Spans of equal
   content are repeated as a whole; copies, however many, are one row from here on.
3. Where the spans of an anchor differ, a match ends inside them. Their windows are hashed from the
   texts and compared one by one, one text for each distinct span.
4. The repeated windows of a text, merged, are its maximal repeats.

Nothing is paired: groups of equal anchors, spans or windows are counted, with partial sums, and
flags return to their places by joins in which a hot key can be split. Sequences are equal when two
independent 64-bit hashes are.

Nulls and empty texts have no words; a text shorter than a window loses nothing. Rows that repeat,
id and all, are repeats of one another. A row without an id is treated by its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import KEY, KEY_TYPES, Batches, keyed_texts, map_batches, packed, unpacked
from geolink.llm.winnow import BASES, SequenceHash, hash_words, spans, split_words
from geolink.operators.staging import stage_table

WINDOW = 35
GRAM = 8

def _seeds(window: int, gram: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = spans(hash_words(batch["text"].to_pylist()), window, gram)
            doc = pa.array(found.doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["text_id"].take(doc),
                    batch["text_version"].take(doc),
                    pa.array(found.anchor.view(np.int64)),
                    pa.array(found.content.view(np.int64)),
                    pa.array(found.first.astype(np.int32)),
                    pa.array(found.last.astype(np.int32)),
                ],
                names=[*KEY, "anchor", "content", "first", "last"],
            )

    return run


def _windows(window: int):
    """One row for each window of the spans of a text: two hashes, its start, whether it is open."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = hash_words(batch["text"].to_pylist())
            lists = batch["spans"]
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            spans_ = lists.flatten()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            first = spans_.field("first").to_numpy(zero_copy_only=False).astype(np.int64)
            count = spans_.field("last").to_numpy(zero_copy_only=False) - first + 1
            open_ = spans_.field("open").to_numpy(zero_copy_only=False)
            span = np.repeat(np.arange(len(first)), count)
            start = first[span] + np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
            at = start + found.starts[doc[span]]
            both = [SequenceHash(found.hashes, b).runs(at, at + window) for b in BASES]
            place = pa.array(doc[span])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["text_id"].take(place),
                    batch["text_version"].take(place),
                    pa.array(both[0].view(np.int64)),
                    pa.array(both[1].view(np.int64)),
                    pa.array(start.astype(np.int32)),
                    pa.array(open_[span]),
                ],
                names=[*KEY, "h1", "h2", "start", "open"],
            )

    return run


def _repeated(df: DataFrame, *key: str) -> DataFrame:
    """Keys with several rows, staged: a join with a table can split the rows of a frequent key."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("places"))
    return stage_table(counted.filter("places > 1").select(*key), "repeated")


def repeated_ranges(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``text_id, text_version, ranges``: the repeated window starts of each text that has any.

    A range is a struct of the ``first`` and ``last`` start of a run; runs may touch or overlap.
    """
    texts = keyed_texts(docs, id_col, text_col).filter("text is not null")
    seeds = map_batches(
        texts,
        _seeds(window, gram),
        f"{KEY_TYPES}, anchor bigint, content bigint, first int, last int",
    )
    # Staged: the extension reads the seeds of repeated anchors several times.
    kept = stage_table(seeds.join(_repeated(seeds, "anchor"), "anchor", "left_semi"), "seeds")
    distinct = stage_table(
        kept.groupBy("anchor", "content").agg(
            F.count(F.lit(1)).alias("places"), F.min(F.struct(*KEY, "first", "last")).alias("one")
        ),
        "spans",
    )
    whole = kept.join(
        distinct.filter("places > 1").select("anchor", "content"), ["anchor", "content"], "left_semi"
    ).select(*KEY, "first", "last")
    differing = distinct.join(_repeated(distinct, "anchor"), "anchor", "left_semi")
    per_text = (
        differing.select("one.*", (F.col("places") == 1).alias("open"))
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("first", "last", "open")).alias("spans"))
    )
    windows = map_batches(
        texts.join(per_text, KEY).select(*KEY, "text", "spans"),
        _windows(window),
        f"{KEY_TYPES}, h1 bigint, h2 bigint, start int, open boolean",
    )
    single = (
        windows.filter("open")
        .join(_repeated(windows, "h1", "h2"), ["h1", "h2"], "left_semi")
        .select(*KEY, F.col("start").alias("first"), F.col("start").alias("last"))
    )
    return (
        whole.unionByName(single)
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    )


def covered(count: int, ranges: list[dict] | None, window: int) -> np.ndarray:
    """Which of ``count`` words lie in a window that starts in one of the ranges."""
    steps = np.zeros(count + 1, np.int64)
    for r in ranges or ():
        steps[r["first"]] += 1
        steps[r["last"] + window] -= 1
    return np.cumsum(steps[:count]) > 0


def _cuts(batch: pa.RecordBatch, window: int) -> Iterator[tuple[bytes | None, list[bytes], np.ndarray]]:
    for text, ranges in zip(batch["text"].to_pylist(), batch["ranges"].to_pylist(), strict=True):
        found = split_words(text)
        yield text, found, covered(len(found), ranges, window)


def _kept_words(found: list[bytes], cut: np.ndarray) -> bytes:
    if not cut.any():
        return b" ".join(found)
    return b" ".join([found[i] for i in np.flatnonzero(~cut).tolist()])


def _with_ranges(docs: DataFrame, window, gram, id_col, text_col, *more) -> DataFrame:
    ranges = repeated_ranges(docs, window, gram, id_col, text_col)
    return keyed_texts(docs, id_col, text_col, *more).join(ranges, KEY, "left")


def repeat_digests(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_removed`` and ``kept_sha256`` of the kept words."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [
                (len(found), int(cut.sum()), hashlib.sha256(_kept_words(found, cut)).hexdigest())
                for _, found, cut in _cuts(batch, window)
            ]
            total, removed, digest = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(digest, pa.string()),
                ],
                names=["id", "n_words", "n_removed", "kept_sha256"],
            )

    joined = _with_ranges(docs, window, gram, id_col, text_col, F.col(f"`{id_col}`").alias("id"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(
        joined.select("id", "text", "ranges"),
        run,
        f"id {kind}, n_words bigint, n_removed bigint, kept_sha256 string",
    ).withColumnRenamed("id", id_col)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows and columns of ``docs`` with the repeated words cut out of the text.

    A text that loses nothing stays as it is. Of others the kept words remain, joined by one space.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            kept = [
                _kept_words(found, cut) if cut.any() else text
                for text, found, cut in _cuts(batch, window)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(kept, pa.binary()).cast(pa.string())], names=["row", "kept"]
            )

    joined = _with_ranges(docs, window, gram, id_col, text_col, packed(docs, text_col))
    joined = joined.select("row", "text", "ranges")
    schema = f"row {joined.schema['row'].dataType.simpleString()}, kept string"
    return unpacked(map_batches(joined, run, schema), docs, text_col, "kept")
