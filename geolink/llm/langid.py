"""Language identification by a string kernel, Nyström landmarks and kernel ridge regression.

The kernel of two texts counts the character n-grams of several lengths that both have (blended spectrum,
presence only), divided by the root of how many each has. N-grams are hashed into ``BUCKETS``; a text
is then the set of its buckets. A few texts of each language are landmarks Z; a text's features are
its kernels with them. One-versus-rest ridge regression on these features (Nyström) is solved on a
bounded sample: ``PER_LANGUAGE`` texts of each language with the smallest hash of their id, ``SAMPLE``
in all, of up to ``SAMPLE_CHARS`` characters. The sets, not the texts, come to the driver.

The kernel is linear in the set, so that landmarks and ridge weights multiply to one matrix of buckets by
languages. A batch of texts is scored by the product of its matrix of sets and that one. Every row is
scored, whole texts, in one pass without a shuffle. Only the text is an input of a prediction.

A text that is null or has no letter is ``und``, with score 0; so is every text if nothing was learned.
A repeated id is sampled by row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
PER_LANGUAGE = 400
SAMPLE = 4000
#: Groups of input tasks among which the sample is drawn first.
PARTS = 256
SAMPLE_CHARS = 20_000
LANDMARKS = 48
RIDGE = 1e-3
#: How sharply margins become scores.
SHARPNESS = 4.0
UNKNOWN = "und"
#: Texts in one matrix, and characters of a text that are hashed at a time.
ROWS = 64
PIECE = 1 << 18

_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def presence(texts: list[str]) -> np.ndarray:
    """One row for each text: which buckets its n-grams fall into."""
    out = np.zeros((len(texts), BUCKETS), bool)
    flat = out.ravel()
    pieces, owners = [], []
    for i, text in enumerate(texts):
        low = text.lower()
        step = PIECE - max(ORDERS) + 1
        for start in range(0, max(len(low), 1), step):
            pieces.append(low[start : start + PIECE])
            owners.append(i)
    at = 0
    while at < len(pieces):
        stop, size = at, 0
        while stop < len(pieces) and (size == 0 or size + len(pieces[stop]) <= PIECE):
            size += len(pieces[stop])
            stop += 1
        block = pieces[at:stop]
        chars = np.frombuffer("".join(block).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(p) for p in block])
        ends = np.repeat(np.cumsum(sizes), sizes)
        base = np.repeat(np.array(owners[at:stop]) * BUCKETS, sizes)
        place = np.arange(len(chars))
        code = np.zeros(len(chars), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            count = len(chars) - n + 1
            if count <= 0:
                break
            code = (code[:count] ^ chars[n - 1 :]) * np.uint32(_MULTIPLIERS[n % 4])
            code ^= code >> np.uint32(15)
            if n in ORDERS:
                inside = place[:count] + n <= ends[:count]
                bucket = (code * np.uint32(_MULTIPLIERS[0] + 2 * n)) >> np.uint32(32 - 15)
                flat[base[:count][inside] + bucket[inside].astype(np.int64)] = True
        at = stop
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _normed(sets: np.ndarray) -> np.ndarray:
    """Sets divided by the root of their size, for kernels as products."""
    x = sets.astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


class Model(NamedTuple):
    languages: tuple[str, ...]
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Scores of the languages, which add up to one."""
        margins = _normed(presence(texts)) @ self.weights
        e = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)


def fit(sets: np.ndarray, languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Ridge regression of one-versus-rest targets on the kernels with landmarks.

    The first ``landmarks`` texts of each language in the given order are the landmarks.
    """
    names = tuple(sorted(set(languages)))
    if not names:
        return Model((), np.zeros((BUCKETS, 0), np.float32))
    label = np.array([names.index(x) for x in languages])
    chosen = np.concatenate([np.flatnonzero(label == k)[:landmarks] for k in range(len(names))])
    x = _normed(sets)
    z = x[chosen]
    kernel, within = (x @ z.T).astype(np.float64), (z @ z.T).astype(np.float64)
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Each language weighs the same, whatever its share of the sample.
    weight = (len(label) / (len(names) * np.bincount(label, minlength=len(names))))[label]
    left = kernel.T @ (kernel * weight[:, None]) + ridge * len(label) * within
    left += 1e-6 * np.trace(left) / len(left) * np.eye(len(left))
    solved = np.linalg.solve(left, kernel.T @ (target * weight[:, None]))
    return Model(names, (z.T @ solved).astype(np.float32))


def held_out(id_: Column) -> Column:
    """Whether a document is kept from learning: its id's checksum has remainder 1 by 3."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    sample: int = SAMPLE,
) -> Model:
    """The model of a bounded sample of the rows that are not held out."""
    text, id_, lang = (F.col(f"`{c}`") for c in (text_col, id_col, lang_col))
    rows = docs.filter(
        ~held_out(id_)
        & lang.isNotNull()
        & (lang != UNKNOWN)
        & text.rlike(r"\p{L}")
        & (F.length(text) <= SAMPLE_CHARS)
    )
    rows = rows.select(lang.alias("lang"), F.xxhash64(id_, text).alias("draw"), text.alias("text"))
    # First among the rows of some input tasks, then among what these leave, so that no task gets what
    # all input tasks leave of a language.
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    some = F.row_number().over(W.partitionBy("lang", "part").orderBy("draw"))
    few = rows.select("lang", "draw").withColumn("part", part)
    few = few.withColumn("rank", some).filter(F.col("rank") <= per_language).select("lang", "draw").distinct()
    rank = F.row_number().over(W.partitionBy("lang").orderBy("draw"))
    few = few.withColumn("rank", rank).filter(F.col("rank") <= per_language)
    few = few.orderBy("rank", "lang").limit(sample).distinct()
    chosen = rows.join(F.broadcast(few), ["lang", "draw"]).select("lang", "rank", "text")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                bits = np.packbits(presence(part["text"].to_pylist()), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part["lang"], part["rank"], pa.array([b.tobytes() for b in bits], pa.binary())],
                    names=["lang", "rank", "bits"],
                )

    sets = map_batches(chosen, run, "lang string, rank int, bits binary")
    found = sorted((r["rank"], r["lang"], bytes(r["bits"])) for r in sets.limit(sample).collect())
    bits = np.frombuffer(b"".join(b for *_, b in found), np.uint8).reshape(-1, BUCKETS // 8)
    unpacked = np.unpackbits(bits, axis=1).astype(bool)
    return fit(unpacked, [lang for _, lang, _ in found])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``held_out``, ``lang_pred`` and its ``score`` from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        own = shared.value
        for batch in batches:
            texts = batch["text"].to_pylist()
            names = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if own.languages and has_letter(t)]
            for low in range(0, len(known), ROWS):
                at = known[low : low + ROWS]
                found = own.scores([texts[i] for i in at])
                for i, row in zip(at, found, strict=True):
                    best = int(row.argmax())
                    names[i], scores[i] = own.languages[best], float(row[best])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["held_out"], pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1))],
                names=["id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    id_ = F.col(f"`{id_col}`")
    rows = docs.select(id_.alias("id"), held_out(id_).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    schema = f"id {kind}, held_out boolean, lang_pred string, score double"
    return map_batches(rows, run, schema).withColumnRenamed("id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the rows that are not held out and predicts all."""
    return predict(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
