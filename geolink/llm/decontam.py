"""Benchmark decontamination by a generalised suffix automaton of the test items.

Texts and items are read alike: A-Z in lower case, words of ASCII letters, digits and all characters
beyond ASCII. A window is ``window`` consecutive words of an item, or the whole of a shorter item. The
automaton of the items runs over the words of each text and tracks the longest match that ends
there; where it is a window or more, the words of the window are hit.

Items are taken in blocks of bounded size. A worker builds a block's automaton when it needs it and
keeps the latest few. Texts pass all blocks in narrow stages: there is no shuffle.

Null and empty texts and items have no words. Repeated items are one in the automaton and all named.
An item without an id is matched, but cannot be named.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches, packed, unpacked

WINDOW = 10
#: Bytes of item texts in one block; a longer item is a block of its own.
BLOCK_BYTES = 256 * 1024
#: Automata that a worker keeps.
KEPT = 8
#: A text with a larger share of hit words is dropped whole.
COVERAGE = 0.5

_plain = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text in UTF-8."""
    return text.translate(_plain).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: list[tuple[int, int | None, int]] = []
        for name, found in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found]
            last = 0
            for i, w in enumerate(ids):
                last = self._extend(last, w)
                if i + 1 >= window:
                    ends.append((last, name, window))
            if 0 < len(ids) < window:
                ends.append((last, name, len(ids)))
        self._mark(ends)

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        """The state of the sequence so far and one more word."""
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            exact = self.length[q] == self.length[p] + 1
            self.link[new] = q if exact else self._split(p, w, q)
        return new

    def _mark(self, ends: list[tuple[int, int | None, int]]) -> None:
        """Windows by the state that holds them: their length, and the items that have them.

        Each state then names the nearest state up the suffix links that holds any.
        """
        self.windows: list[dict[int, set]] = [{} for _ in self.next]
        for state, name, size in ends:
            while self.length[self.link[state]] >= size:
                state = self.link[state]
            self.windows[state].setdefault(size, set()).add(name)
        self.holder = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.holder[state] = state if self.windows[state] else self.holder[self.link[state]]

    def ids(self, found: list[bytes]) -> list[int]:
        return list(map(self.vocabulary.get, found, repeat(-1)))

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Runs of hit words as (start, stop), and the items whose windows occur."""
        ids = self.ids(found)
        known = np.array(ids) >= 0
        edges = np.flatnonzero(np.diff(np.r_[False, known, False]))
        runs: list[tuple[int, int]] = []
        names: set = set()
        seen: set[tuple[int, int]] = set()
        for start, stop in edges.reshape(-1, 2).tolist():
            if stop - start >= self.shortest:
                self._run(ids, start, stop, runs, seen)
        for state, size in seen:
            names |= self.windows[state][size]
        return runs, names

    @property
    def shortest(self) -> int:
        """Words of the shortest window."""
        if not hasattr(self, "_shortest"):
            self._shortest = min((s for w in self.windows for s in w), default=1)
        return self._shortest

    def _run(self, ids, start, stop, runs, seen) -> None:
        moves, link, length, holder = self.next, self.link, self.length, self.holder
        state = matched = 0
        for i in range(start, stop):
            w = ids[i]
            while state and w not in moves[state]:
                state = link[state]
                matched = length[state]
            if w in moves[state]:
                state = moves[state][w]
                matched += 1
            at = holder[state]
            while at > 0:
                for size in self.windows[at]:
                    if size <= matched:
                        seen.add((at, size))
                        low = i + 1 - size
                        while runs and runs[-1][1] >= low and runs[-1][0] >= low:
                            runs.pop()
                        if runs and runs[-1][1] >= low:
                            low = runs.pop()[0]
                        runs.append((low, i + 1))
                at = holder[link[at]]


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size, by a local iterator: one partition at the driver at a time."""
    block, size = [], 0
    chosen = items.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    for name, text in chosen.filter("t is not null").orderBy("i", "t").toLocalIterator():
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((name, bytes(text)))
        size += len(text)
    if block:
        yield block


def _shared_blocks(items: DataFrame, id_col: str, text_col: str) -> list:
    context = items.sparkSession.sparkContext
    return [
        context.broadcast((hashlib.sha256(repr(block).encode()).hexdigest(), block))
        for block in _blocks(items, id_col, text_col)
    ]


_automata: OrderedDict[tuple[str, int], Automaton] = OrderedDict()


def _automaton(broadcast, window: int) -> Automaton:
    """The worker's automaton of a block."""
    mark, block = broadcast.value
    if (mark, window) not in _automata:
        while len(_automata) >= KEPT:
            _automata.popitem(last=False)
        items = [(name, words(text)) for name, text in block]
        _automata[mark, window] = Automaton(items, window)
    return _automata[mark, window]


def _scan(broadcast, window: int):
    """Adds the hits of one block to the columns ``runs`` and ``items``."""

    def run(batches: Batches) -> Batches:
        automaton = _automaton(broadcast, window)
        for batch in batches:
            all_runs, all_names = [], []
            for text, runs, names in zip(*(batch[c].to_pylist() for c in ("text", "runs", "items")), strict=True):
                more, found = automaton.hits(words(text))
                all_runs.append((runs or []) + [i for r in more for i in r])
                all_names.append(sorted({*(names or []), *(n for n in found if n is not None)}))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["text"], pa.array(all_runs, pa.list_(pa.int32())), pa.array(all_names, batch.schema.field("items").type)],
                names=["row", "text", "runs", "items"],
            )

    return run


def _scanned(docs, items, text_col, item_id_col, item_text_col, window, row) -> DataFrame:
    kind = items.schema[item_id_col].dataType.simpleString()
    df = docs.select(
        row,
        F.col(f"`{text_col}`").cast("binary").alias("text"),
        F.lit(None).cast("array<int>").alias("runs"),
        F.lit(None).cast(f"array<{kind}>").alias("items"),
    )
    schema = f"row {df.schema['row'].dataType.simpleString()}, text binary, runs array<int>, items array<{kind}>"
    for block in _shared_blocks(items, item_id_col, item_text_col):
        df = map_batches(df, _scan(block, window), schema)
    return df


def hit_mask(count: int, runs: list[int] | None) -> np.ndarray:
    steps = np.zeros(count + 1, np.int64)
    for low, high in zip((runs or [])[::2], (runs or [])[1::2], strict=True):
        steps[low] += 1
        steps[high] -= 1
    return np.cumsum(steps[:count]) > 0


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_hit``, ``n_items`` and ``items`` whose windows occur."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            counts = []
            for text, runs in zip(batch["text"].to_pylist(), batch["runs"].to_pylist(), strict=True):
                total = len(words(text))
                counts.append((total, int(hit_mask(total, runs).sum()) if runs else 0))
            total, hit = zip(*counts, strict=True) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(total, pa.int64()), pa.array(hit, pa.int64()), batch["items"]],
                names=["row", "n_words", "n_hit", "items"],
            )

    row = F.struct(F.col(f"`{id_col}`")).alias("row")
    df = _scanned(docs, items, text_col, item_id_col, item_text_col, window, row)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    found = map_batches(df, run, f"row {kinds['row']}, n_words bigint, n_hit bigint, items {kinds['items']}")
    named = F.coalesce("items", F.array().cast(kinds["items"]))
    return found.select(
        F.col(f"row.`{id_col}`").alias(id_col),
        "n_words",
        "n_hit",
        F.size(named).cast("long").alias("n_items"),
        named.alias("items"),
    )


def contamination_digests(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``contamination`` with the items as a digest of their sorted, comma-joined ids."""
    found = contamination(docs, items, **options)
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.withColumn("items_sha256", F.sha2(names, 256)).withColumn(
        "contaminated", F.col("n_hit") > 0
    ).drop("items")


def _without(text: bytes, mask: np.ndarray) -> bytes:
    """The text without its hit words; what stood before each goes with it."""
    out, at, plain = [], 0, text.translate(_plain)
    for word, hit in zip(plain.split(), mask.tolist(), strict=True):
        begin = plain.index(word, at)
        end = begin + len(word)
        if not hit:
            out.append(text[at:end])
        at = end
    return b"".join(out) + text[at:]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows and columns of ``docs`` without the benchmark.

    Hit words are cut out of the text, which otherwise stays as it is; a text of which more than
    ``coverage`` is hit is dropped. A cut can bring parts together that form a window again; the
    text is then cut again until there is none.
    """
    shared = _shared_blocks(items, item_id_col, item_text_col)

    def cut_all(texts: list[bytes | None]) -> list[bool]:
        """Cuts the texts in place; tells which stay."""
        total = [len(words(t)) for t in texts]
        lost, stays, active = [0] * len(texts), [True] * len(texts), range(len(texts))
        while active:
            runs: dict[int, list[int]] = {i: [] for i in active}
            for block in shared:
                automaton = _automaton(block, window)
                for i in active:
                    runs[i] += [k for r in automaton.hits(words(texts[i]))[0] for k in r]
            active = [i for i in active if runs[i]]
            for i in active:
                mask = hit_mask(len(words(texts[i])), runs[i])
                lost[i] += int(mask.sum())
                stays[i] = lost[i] <= coverage * total[i]
                texts[i] = _without(texts[i], mask)
            active = [i for i in active if stays[i]]
        return stays

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch["text"].to_pylist()
            stays = pa.array(cut_all(texts), pa.bool_())
            body = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch["row"], body], names=["row", "body"]).filter(stays)

    df = docs.select(packed(docs, text_col), F.col(f"`{text_col}`").cast("binary").alias("text"))
    schema = f"row {df.schema['row'].dataType.simpleString()}, body string"
    return unpacked(map_batches(df, run, schema), docs, text_col, "body")
