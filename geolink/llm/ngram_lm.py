"""Language-model scoring by an Elias-Fano n-gram trie.

Tokens are the words of a text, A-Z lower-cased, and one end. The trie has two levels. The first holds
the training tokens, by their hashes in order, as an Elias-Fano sequence, with their counts; a token's
id is its position. The second holds the contexts (a token, or the start of a text) that have stored
successors, monotone pointers to where each context's successors begin, and the successors: relative to
their context, so that all of them are one monotone sequence. All three are Elias-Fano sequences. A
bigram is looked up by finding its context, then its successor within the context's range.

Probabilities are smoothed by absolute discounting and interpolation, with the token's own probability
``(c + 1) / (N + V + 1)`` below, which leaves room for one unknown token:

    p(w | h) = max(c(h, w) - D, 0) / c(h) + left(h) p(w)

All bigrams are stored (those counted ``least`` times and more, if a caller asks), with the logarithm of
their discounted share, the first term, quantised to 16 bits; ``left(h)``, all that the stored ones leave,
likewise. Every training token is counted. Probabilities of a context add up to one, but for rounding.

The levels are built by range: each task writes the arrays of its shard into the shared folder, and names
them in its result, so that what a lost task wrote is never read. Where the shards of bigrams are cut follows
from the counts of the tokens, since a context has as many bigrams as it has occurrences: a shard has about
``SHARD`` of them, and a context with more is cut by its successors. What such a context leaves is added up
over its shards and kept with the model. Tasks count bigrams in chunks of ``CHUNK`` tokens and send sorted
runs, one for each shard, so that bigrams are shuffled once.

Scoring tasks map the files into memory: they take page cache, not heap, and only the pages that are asked
for; a worker keeps ``OPEN`` shards open. Distinct bigrams of a chunk are looked up once, in order. The folder
that ``spark.checkpoint.dir`` names must be mounted on the executors for that.

A null text is empty: it has the end alone. Rows that repeat count and are scored each. Without training
rows N and V are 0, and every token has probability one.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches
from geolink.llm.elias_fano import EliasFano
from geolink.operators.staging import shared_folder, stage_table

#: Least count of a stored bigram unless a caller says otherwise, and the discount of each count.
LEAST = 1
DISCOUNT = 0.75
#: Entries of a shard, tokens of a chunk, shards that a worker keeps open.
SHARD = 1_000_000
CHUNK = 1_000_000
OPEN = 512
#: Steps of a quantised logarithm (base 10); 16 bits reach down to -16.
STEPS = 4096
_TOP = np.uint64(1 << 63)


def token_hash(word: bytes) -> int:
    """Hash of a token as a long, whose order is that of the unsigned hash."""
    return xxhash.xxh64_intdigest(word) - 2**63


#: No word holds a line break.
END = token_hash(b"\n")


class Tokens(NamedTuple):
    """Hashes of the tokens of a batch, one text after the other, and where each text begins."""

    hashes: np.ndarray
    starts: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


def tokenize(texts: list[bytes | None]) -> Tokens:
    digest = xxhash.xxh64_digest
    end = digest(b"\n")
    found, starts = [], [0]
    for text in texts:
        words = text.lower().split() if text else []
        found += map(digest, words)
        found.append(end)
        starts.append(len(found))
    hashes = np.frombuffer(b"".join(found), ">u8").astype(np.uint64) ^ _TOP
    return Tokens(hashes.view(np.int64), np.array(starts, np.int64))


def chunks(batches: Batches) -> Iterator[tuple[list[pa.RecordBatch], Tokens]]:
    """The batches of a task in chunks of ``CHUNK`` tokens or more, with their tokens."""
    held: list[tuple[pa.RecordBatch, Tokens]] = []
    size = 0
    for batch in batches:
        held.append((batch, tokenize(batch["text"].to_pylist())))
        size += len(held[-1][1].hashes)
        if size >= CHUNK:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[pa.RecordBatch, Tokens]]) -> tuple[list[pa.RecordBatch], Tokens]:
    hashes = np.concatenate([t.hashes for _, t in held])
    sizes = np.concatenate([t.sizes for _, t in held])
    return [b for b, _ in held], Tokens(hashes, np.r_[0, np.cumsum(sizes)])


class Sums:
    """Counts by key, added up whenever as many as ``limit`` are pending."""

    def __init__(self, limit: int):
        self.limit, self.parts, self.pending = limit, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.pending += len(keys)
        if self.pending > self.limit and len(self.parts) > 1:
            self.parts = [self.total()]
            # As many again may come before the next time.
            self.pending = max(0, len(self.parts[0][0]) - self.limit // 2)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, each once, and their counts."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


class Shard(NamedTuple):
    """One shard's files and the range of its keys; ``offset`` entries are in the shards before."""

    path: str
    first: int
    size: int
    offset: int
    shapes: dict[str, tuple[int, int]]


class Model(NamedTuple):
    """The shards, and contexts that several shards share (``wide``, in order) with what they leave."""

    tokens: tuple[Shard, ...]
    contexts: tuple[Shard, ...]
    total: int
    distinct: int
    texts: int
    wide: np.ndarray
    left: np.ndarray

    @property
    def start(self) -> int:
        """Id of the start of a text, as a context."""
        return self.distinct

    def keys(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """One number for a bigram, in the order of context and word; an unknown one is -1."""
        return context * (self.distinct + 1) + word + 1


def _local(folder: str) -> str:
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise RuntimeError(f"the folder of the model must be mounted, which {folder} is not")
    return url.path


def _write(folder: str, sequences: dict[str, EliasFano], arrays: dict[str, np.ndarray]) -> tuple[str, dict]:
    """Writes the arrays of a shard; gives its path and the shapes of its sequences."""
    path = f"{folder}/{uuid.uuid4().hex}"
    os.makedirs(path)
    shapes = {}
    for name, sequence in sequences.items():
        shapes[name] = (sequence.size, sequence.bits)
        arrays = arrays | {f"{name}-{k}": v for k, v in sequence.arrays().items()}
    for name, values in arrays.items():
        np.save(f"{path}/{name}.npy", values)
    return path, shapes


_opened: OrderedDict[str, dict] = OrderedDict()


def _open(shard: Shard) -> dict:
    """The shard's arrays, mapped into memory; the ones asked for last stay open."""
    if shard.path in _opened:
        _opened.move_to_end(shard.path)
        return _opened[shard.path]
    while len(_opened) >= OPEN:
        _opened.popitem(last=False)
    read = {
        name.removesuffix(".npy"): np.load(f"{shard.path}/{name}", mmap_mode="r")
        for name in os.listdir(shard.path)
    }
    sequences = {
        name: EliasFano(size, bits, *(read[f"{name}-{k}"] for k in ("low", "high", "ones", "zeros")))
        for name, (size, bits) in shard.shapes.items()
    }
    _opened[shard.path] = read | sequences
    return _opened[shard.path]


def _by_shard(shards: tuple[Shard, ...], keys: np.ndarray) -> Iterator[tuple[Shard, np.ndarray]]:
    """Shards with the positions of the sorted keys that fall into their ranges."""
    cuts = [*np.searchsorted(keys, np.array([s.first for s in shards], np.int64)), len(keys)]
    for shard, low, high in zip(shards, cuts[:-1], cuts[1:], strict=True):
        if low < high:
            yield shard, np.arange(low, high)


def _unsigned(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.uint64) ^ _TOP


def find_tokens(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1 if unknown) and counts of sorted hashes."""
    ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
    for shard, at in _by_shard(model.tokens, hashes):
        opened = _open(shard)
        whole = np.zeros(len(at), np.int64)
        place = opened["hash"].find(_unsigned(hashes[at]), whole, whole + shard.size)
        known = place >= 0
        ids[at[known]] = place[known] + shard.offset
        counts[at[known]] = opened["count"][place[known]]
    return ids, counts


def counts_of_ids(model: Model, ids: np.ndarray) -> np.ndarray:
    """Counts of sorted ids; the start of a text counts the texts."""
    counts = np.full(len(ids), model.texts, np.int64)
    offsets = np.array([s.offset for s in model.tokens], np.int64)
    owner = np.searchsorted(offsets, ids, side="right") - 1
    for k in np.unique(owner[ids < model.distinct]).tolist():
        at = np.flatnonzero((owner == k) & (ids < model.distinct))
        counts[at] = _open(model.tokens[k])["count"][ids[at] - model.tokens[k].offset]
    return counts


def quantised(logarithm: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-logarithm * STEPS), 0, 65535).astype(np.uint16)


def score_bigrams(model: Model, context: np.ndarray, word: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Logarithms of p(word | context); ``below`` are those of p(word). Equal bigrams are looked up once."""
    keys, first, back = np.unique(model.keys(context, word), return_index=True, return_inverse=True)
    share, left = np.zeros(len(keys)), np.ones(len(keys))
    context, word = context[first], word[first]
    for shard, at in _by_shard(model.contexts, keys):
        opened = _open(shard)
        edge = np.flatnonzero(np.r_[True, np.diff(context[at]) != 0])
        names = context[at[edge]].astype(np.uint64)
        whole = np.zeros(len(names), np.int64)
        place = opened["context"].find(names, whole, whole + shard.size)
        rows = np.diff(np.r_[edge, len(at)])
        known = place >= 0
        at, place, rows = at[np.repeat(known, rows)], place[known], rows[known]
        if not len(at):
            continue
        left[at] = np.repeat(10 ** (opened["left"][place] / -STEPS), rows)
        begin = opened["pointer"].access(place).astype(np.int64)
        end = opened["pointer"].access(place + 1).astype(np.int64)
        place, begin, end = (np.repeat(v, rows) for v in (place, begin, end))
        known = word[at] >= 0
        at, place, begin, end = at[known], place[known], begin[known], end[known]
        wanted = place.astype(np.uint64) * np.uint64(model.distinct) + word[at].astype(np.uint64)
        found = opened["successor"].find(wanted, begin, end)
        hit = found >= 0
        share[at[hit]] = 10 ** (opened["share"][found[hit]] / -STEPS)
    if len(model.wide):
        at = np.minimum(np.searchsorted(model.wide, context), len(model.wide) - 1)
        left = np.where(model.wide[at] == context, model.left[at], left)
    return np.log10(share + left * 10 ** below[first])[back]


_BUILT = "path string, first bigint, size bigint, names array<string>, shapes array<bigint>, more array<double>"


def _built(path: str, first: int, size: int, shapes: dict, more: list[float]) -> pa.RecordBatch:
    flat = [x for name in sorted(shapes) for x in shapes[name]]
    return pa.RecordBatch.from_pydict(
        {
            "path": [path],
            "first": [first],
            "size": [size],
            "names": [sorted(shapes)],
            "shapes": pa.array([flat], pa.list_(pa.int64())),
            "more": pa.array([more], pa.list_(pa.float64())),
        }
    )


def _shards(built: DataFrame) -> tuple[tuple[Shard, ...], list[list[float]]]:
    """The shards in order, and what else their tasks tell; their few rows come to the driver."""
    shards, offset, more = [], 0, []
    for r in sorted(built.collect(), key=lambda r: r["first"]):
        pairs = zip(r["names"], zip(r["shapes"][::2], r["shapes"][1::2], strict=True), strict=True)
        shards.append(Shard(r["path"], r["first"], r["size"], offset, dict(pairs)))
        offset += r["size"]
        more.append(r["more"])
    return tuple(shards), more


def _count_tokens(batches: Batches) -> Batches:
    sums = Sums(SHARD)

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in sums.total()], names=["hash", "n"])

    for _, tokens in chunks(batches):
        found, counts = np.unique(tokens.hashes, return_counts=True)
        sums.add(found, counts)
        if sums.pending > SHARD // 2:
            yield rows()
            sums = Sums(SHARD)
    yield rows()


def cuts(counts: np.ndarray, limit: int) -> list[float]:
    """Where contexts with these counts are cut into shards: triples of a position, a part and the parts.

    A context with more than ``limit`` occurrences has several parts; others go together.
    """
    upto = np.cumsum(counts)
    wide = np.flatnonzero(counts > limit)
    at = np.searchsorted(upto, np.arange(limit, upto[-1], limit), side="right")
    plain = np.unique(np.r_[0, at, wide + 1])
    plain = plain[(plain < len(counts)) & ~np.isin(plain, wide)]
    out = [x for p in plain.tolist() for x in (p, 0, 1)]
    for p in wide.tolist():
        parts = -(-int(counts[p]) // limit)
        out += [x for k in range(parts) for x in (p, k, parts)]
    return out


def _build_tokens(folder: str, limit: int):
    def run(batches: Batches) -> Batches:
        parts = [[b[n].to_numpy(zero_copy_only=False) for n in ("hash", "n")] for b in batches if b.num_rows]
        if parts:
            hashes, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
            small = np.uint32 if counts.max() < 1 << 32 else np.uint64
            sequences = {"hash": EliasFano.build(_unsigned(hashes))}
            path, shapes = _write(folder, sequences, {"count": counts.astype(small)})
            yield _built(path, int(hashes[0]), len(hashes), shapes, cuts(counts, limit))

    return run


class Bigrams(NamedTuple):
    """The bigrams of a chunk: ids of context and word, the word's count and the logarithm of p(word)."""

    context: np.ndarray
    word: np.ndarray
    below: np.ndarray
    count: np.ndarray


def bigrams(model: Model, tokens: Tokens) -> Bigrams:
    distinct, back = np.unique(tokens.hashes, return_inverse=True)
    ids, counts = find_tokens(model, distinct)
    below = np.log10((counts + 1) / (model.total + model.distinct + 1))
    word = ids[back]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[tokens.starts[:-1]] = model.start
    return Bigrams(context, word, below[back], counts[back])


def packed_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Keys in order and their counts as bytes, by digit, which compress well: high digits are zeros."""
    steps = np.diff(keys, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.concatenate([steps, counts.astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1).T.tobytes()


def unpacked_run(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    digits = np.frombuffer(run, np.uint8).reshape(12, -1).T
    steps, counts = (np.ascontiguousarray(d) for d in (digits[:, :8], digits[:, 8:]))
    return np.cumsum(steps.view("<u8").ravel().astype(np.int64)), counts.view("<u4").ravel().astype(np.int64)


def _count_bigrams(model: Model, firsts: np.ndarray):
    """Sorted runs of a chunk's bigrams, one for each shard, which begin at ``firsts``."""

    def run(batches: Batches) -> Batches:
        for _, tokens in chunks(batches):
            found = bigrams(model, tokens)
            keys, counts = np.unique(model.keys(found.context, found.word), return_counts=True)
            edges = np.r_[np.searchsorted(keys, firsts), len(keys)]
            parts = np.flatnonzero(np.diff(edges))
            runs = [packed_run(keys[i:j], counts[i:j]) for i, j in zip(edges[parts], edges[parts + 1], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(runs, pa.binary())], names=["part", "run"])

    return run


def _build_contexts(folder: str, model: Model, firsts: np.ndarray, least: int, discount: float):
    """The arrays of one shard: a partition has the runs of one."""

    def run(batches: Batches) -> Batches:
        sums, number = Sums(4 * SHARD), 0
        for batch in batches:
            number = batch["part"][0].as_py() if batch.num_rows else number
            for part in batch["run"]:
                sums.add(*unpacked_run(part.as_py()))
        keys, n = sums.total()
        keys, n = keys[n >= least], n[n >= least]
        if not len(keys):
            return
        context, word = np.divmod(keys, model.distinct + 1)
        word -= 1
        present, begin, back = np.unique(context, return_index=True, return_inverse=True)
        total = counts_of_ids(model, present)
        taken = np.bincount(back, n - discount, len(present)) / total
        relative = back.astype(np.uint64) * np.uint64(model.distinct) + word.astype(np.uint64)
        sequences = {
            "context": EliasFano.build(present.astype(np.uint64)),
            "pointer": EliasFano.build(np.r_[begin, len(word)].astype(np.uint64)),
            "successor": EliasFano.build(relative),
        }
        arrays = {
            "left": quantised(np.log10(np.maximum(1 - taken, 1e-12))),
            "share": quantised(np.log10((n - discount) / total[back])),
        }
        path, shapes = _write(folder, sequences, arrays)
        shared = np.flatnonzero(np.isin(present, model.wide))
        more = [float(x) for i in shared for x in (present[i], taken[i])]
        yield _built(path, int(firsts[number]), len(present), shapes, more)

    return run


def _first_keys(model: Model, found: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """The first key of each shard of bigrams, and the contexts that have several shards."""
    span = model.distinct + 1
    firsts, wide = [], set()
    places = [
        (int(p) + shard.offset, int(k), int(parts))
        for shard, flat in zip(model.tokens, found, strict=True)
        for p, k, parts in zip(flat[::3], flat[1::3], flat[2::3], strict=True)
    ]
    starts = -(-model.texts // SHARD)
    for context, k, parts in [*places, *((model.start, k, starts) for k in range(starts))]:
        firsts.append(context * span + span * k // parts)
        if parts > 1:
            wide.add(context)
    return np.array(sorted(set(firsts)), np.int64), np.array(sorted(wide), np.int64)


def train(docs: DataFrame, text_col: str = "text", least: int = LEAST, discount: float = DISCOUNT) -> Model:
    """The trie of all given texts."""
    spark: SparkSession = docs.sparkSession
    folder = f"{_local(shared_folder(spark))}/geolink/trie-{uuid.uuid4().hex}"
    os.makedirs(folder, exist_ok=True)
    texts = docs.select(F.col(f"`{text_col}`").cast("binary").alias("text"))
    counted = map_batches(texts, _count_tokens, "hash bigint, n bigint")
    counts = stage_table(counted.groupBy("hash").agg(F.sum("n").alias("n")), "tokens")
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct"),
        F.coalesce(F.max(F.when(F.col("hash") == END, F.col("n"))), F.lit(0)).alias("texts"),
    ).first()
    parts = max(1, -(-sums["distinct"] // SHARD))
    ordered = counts.repartitionByRange(parts, "hash").sortWithinPartitions("hash")
    tokens, found = _shards(map_batches(ordered, _build_tokens(folder, SHARD), _BUILT))
    none = np.zeros(0)
    model = Model(tokens, (), sums["total"], sums["distinct"], sums["texts"], none.astype(np.int64), none)
    if not model.total:
        return model
    firsts, wide = _first_keys(model, found)
    model = model._replace(wide=wide)
    runs = map_batches(texts, _count_bigrams(model, firsts), "part int, run binary")
    dealt = runs.repartitionById(len(firsts), "part")
    built = map_batches(dealt, _build_contexts(folder, model, firsts, least, discount), _BUILT)
    contexts, ends = _shards(built)
    taken = dict.fromkeys(wide.tolist(), 0.0)
    for flat in ends:
        for context, share in zip(flat[::2], flat[1::2], strict=True):
            taken[int(context)] += share
    left = np.array([max(1 - taken[c], 1e-12) for c in wide.tolist()])
    return model._replace(contexts=contexts, left=left)


def score_texts(docs: DataFrame, model: Model, text_col: str, *more: Column) -> DataFrame:
    """Per row: ``more`` columns, ``n_tokens``, ``n_known``, ``base_score`` and ``score``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        own = shared.value
        for held, tokens in chunks(batches):
            found = bigrams(own, tokens)
            scores = score_bigrams(own, found.context, found.word, found.below)
            text = np.repeat(np.arange(len(tokens.sizes)), tokens.sizes)
            sums = [np.bincount(text, v, len(tokens.sizes)) for v in (found.below, scores)]
            known = np.bincount(text, found.count > 0, len(tokens.sizes)).astype(np.int64)
            row = pa.concat_arrays([b["row"] for b in held])
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(tokens.sizes), pa.array(known), *map(pa.array, sums)],
                names=["row", "n_tokens", "n_known", "base_score", "score"],
            )

    df = docs.select(F.struct(*more).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = df.schema["row"].dataType.simpleString()
    schema = f"row {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    return map_batches(df, run, schema).select("row.*", "n_tokens", "n_known", "base_score", "score")


def held_out(id_: Column) -> Column:
    """Whether a document is kept from training: its id's checksum has remainder 2 by 7."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def score_table(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """Trains on the rows that are not held out and scores all."""
    id_ = F.col(f"`{id_col}`")
    model = train(docs.filter(~held_out(id_)), text_col, least)
    scored = score_texts(docs, model, text_col, id_.alias("id"), held_out(id_).alias("held_out"))
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
