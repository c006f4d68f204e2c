"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Each match of the split pattern is encoded on its own: its halves are encoded recursively and
joined. Two neighbouring encodings are joined by re-encoding a growing window of tokens around
the seam, until the tokens next to the window stay apart from it.

Why that is exact: merges go by rank, then from the left, so that two neighbours' merges affect one
another only through a merge across their border. Where each neighbouring pair of tokens, encoded
alone, gives the pair back, the first merge across any border cannot happen, and the sequence is the
encoding of its bytes. Inside both halves and inside the window every pair is of that kind; the
join therefore checks the borders of the window alone.

Decoding concatenates the bytes of tokens up a tree of halves.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bounds of a worker's memories: runs between spaces, pieces, and short runs of bytes or pairs of
#: tokens. A full one starts anew.
UNITS = 200_000
PIECES = 200_000
MEMORY = 400_000
#: Runs of so many bytes are merged directly; longer ones are halved.
LEAF = 8


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """Encodes and decodes by one table of ranks. All 256 single bytes must have a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.merged: dict[bytes, tuple[bytes, ...]] = {}
        # One object for each token, so that what is remembered stays small.
        self.same = {token: token for token in ranks}.__getitem__

    def merge(self, data: bytes) -> tuple[bytes, ...]:
        """Tokens of a run of bytes, merged pair by pair: the lowest rank, then the left."""
        if len(data) > 32:
            return tuple(self._merge_long(data))
        known = self.merged.get(data)
        if known is None:
            if len(self.merged) >= MEMORY:
                self.merged.clear()
            known = self.merged[data] = tuple(map(self.same, self._merge_short(data)))
        return known

    def _merge_short(self, data: bytes) -> list[bytes]:
        rank, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        ranks = [rank(data[i : i + 2]) for i in range(len(data) - 1)]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1])

    def _merge_long(self, data: bytes) -> list[bytes]:
        """The same by a heap over a linked list of parts."""
        size = len(data)
        ends, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap: list[tuple[int, int, int]] = []

        def push(i: int) -> None:
            j = ends[i]
            if j < size and (r := self.ranks.get(data[i : ends[j]])) is not None:
                heapq.heappush(heap, (r, i, ends[j]))

        for i in range(size - 1):
            push(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if ends[i] < 0 or (j := ends[i]) >= size or ends[j] != stop:
                continue
            ends[i], ends[j] = stop, -1
            if stop < size:
                before[stop] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        parts, i = [], 0
        while i < size:
            parts.append(data[i : ends[i]])
            i = ends[i]
        return parts

    def stay_apart(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens, encoded together, stay these two tokens."""
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) >= MEMORY:
                self.apart.clear()
            known = self.apart[self.same(a), self.same(b)] = self.merge(a + b) == (a, b)
        return known

    def join(self, left: tuple[bytes, ...], right: tuple[bytes, ...]) -> tuple[bytes, ...]:
        """The encoding of two neighbouring encodings."""
        if not left or not right or self.stay_apart(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join(left[-i:] + right[:j]))
            free_left = i >= len(left) or self.stay_apart(left[-i - 1], window[0])
            free_right = j >= len(right) or self.stay_apart(window[-1], right[j])
            if free_left and free_right:
                return left[:-i] + window + right[j:]
            i = i if free_left else min(2 * i, len(left))
            j = j if free_right else min(2 * j, len(right))

    def tree(self, data: bytes) -> tuple[bytes, ...]:
        """Tokens of one piece: halves joined up the tree."""
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Ids of one match of the split pattern. A match that is a token is that token."""
        known = self.ranks.get(data)
        return (known,) if known is not None else tuple(self.ranks[t] for t in self.tree(data))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 65536:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class Pieces(dict):
    """Ids of the pieces seen lately."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.encoder.encode(piece.encode())
        if len(self) >= PIECES:
            self.clear()
        self[piece] = ids
        return ids


class Units(dict):
    """Ids of the runs between single spaces seen lately, each with the space before it.

    Under the public pattern a single space between two other characters always begins a match, so
    that such runs can be split alone. A run that is empty or has white space at an end is refused.
    """

    def __init__(self, split, pieces: Pieces):
        super().__init__()
        self.split, self.pieces = split, pieces

    def __missing__(self, unit: str) -> tuple[int, ...]:
        if not unit or WHITE(unit[0]) or WHITE(unit[-1]):
            raise Refused
        pieces = self.split(" " + unit)
        if len(pieces) == 1:
            ids = self.pieces[pieces[0]]
        else:
            ids = tuple(chain.from_iterable(map(self.pieces.__getitem__, pieces)))
        if len(self) >= UNITS:
            self.clear()
        self[unit] = ids
        return ids


class Refused(Exception):
    """The text has white space that must be split in its context."""


WHITE = regex.compile(r"\p{White_Space}").match


class Tokenizer:
    """Whole texts to ids and back, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = Encoder(ranks)
        # White space is the Unicode property, as in the tokenizer libraries.
        spaces = pattern.replace(r"[^\s", r"[^\p{White_Space}")
        spaces = spaces.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.split = regex.compile(spaces).findall
        self.pieces = Pieces(self.encoder)
        self.units = Units(self.split, self.pieces) if pattern == public_tokenizers.PATTERN else None
        self.decimal = [str(i) for i in range(len(self.encoder.tokens))]

    def _encode_pieces(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.units is None:
            return self._encode_pieces(text)
        first, *units = text.split(" ")
        try:
            if not first or WHITE(first[-1]):
                raise Refused
            ids = list(chain.from_iterable(map(self.units.__getitem__, units)))
        except Refused:
            return self._encode_pieces(text)
        return self._encode_pieces(first) + ids

    def decode(self, ids: list[int]) -> bytes:
        return self.encoder.decode(ids)


_tokenizers: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(path: str, pattern: str = public_tokenizers.PATTERN) -> Tokenizer:
    """The worker's tokenizer for a rank file, read once."""
    if (path, pattern) not in _tokenizers:
        _tokenizers[path, pattern] = Tokenizer(read_ranks(path), pattern)
    return _tokenizers[path, pattern]


def encode_texts(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Per row: the id, ``n_tokens``, ``token_ids`` (unless ``with_ids`` is off), and two digests.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the bytes that the
    ids decode to. One pass without a shuffle. A null text counts as empty: no tokens, and the
    digests of nothing. Other columns are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Batches) -> Batches:
        own = tokenizer(path, pattern)
        decimal = own.decimal.__getitem__
        for batch in batches:
            counts, tokens, ids_digests, text_digests = [], [], [], []
            for text in batch["text"].to_pylist():
                ids = own.encode(text)
                counts.append(len(ids))
                if with_ids:
                    tokens.append(ids)
                ids_digests.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
            columns = {"id": batch["id"], "n_tokens": pa.array(counts, pa.int64())}
            if with_ids:
                columns["token_ids"] = pa.array(tokens, pa.list_(pa.int32()))
            columns["ids_sha256"] = pa.array(ids_digests, pa.string())
            columns["decoded_sha256"] = pa.array(text_digests, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[id_col].dataType.simpleString()
    ids = "token_ids array<int>, " if with_ids else ""
    return map_batches(
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")),
        run,
        f"id {kind}, n_tokens bigint, {ids}ids_sha256 string, decoded_sha256 string",
    ).withColumnRenamed("id", id_col)


def decode_texts(tokens: DataFrame, path: str | None = None, ids_col: str = "token_ids") -> DataFrame:
    """``tokens`` with a binary column ``decoded`` in place of the ids; null ids decode to null."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Batches) -> Batches:
        own = tokenizer(path)
        for batch in batches:
            decoded = [None if ids is None else own.decode(ids) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"row": batch["row"], "decoded": pa.array(decoded, pa.binary())})

    rest = [c for c in tokens.columns if c != ids_col]
    df = tokens.select(F.struct(*rest).alias("row"), F.col(ids_col).alias("ids"))
    schema = f"row {df.schema['row'].dataType.simpleString()}, decoded binary"
    return map_batches(df, run, schema).select("row.*", "decoded")
