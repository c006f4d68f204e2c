"""Toxicity as ordinal regression: a cumulative-link model over sparse word features of sections.

The severity grades are ordered: 0 is not toxic, 1 is toxic, 2 is toxic and of low quality. The model
is ``P(grade <= k) = logistic(threshold_k - w.x)``: one weight vector for all thresholds, which are
kept in order by positive steps. x counts the words of a section that have a chosen feature: to be a certain
word, or to begin in a certain way, so that inflected forms count together. The same word counts ``TIMES``
times at most. Weights are not negative. The result of a text is its expected severity, the sum over k of ``P(grade > k)``.

A text is judged by the worst of its sections of ``SECTION`` words, one every ``STEP`` words, so that its
length does not matter: clean text around a toxic passage does not hide it, and a long text does not add up
the weak features that it has here and there.

The model is fitted on a bounded sample of labelled rows: the ``SAMPLE`` labels with the smallest hash of
their id, as many of their texts, and ``FIT_SECTIONS`` sections of each, evenly spread. Labels are for
texts, not for sections. The sections of a clean text are all clean; of a toxic one the worst is taken for
toxic, which is found by fitting again ``ROUNDS`` times. Tasks count features, then send the chosen features
of the ``KEPT`` worst sections of each text; texts do not reach the driver. Every row is scored, whole texts,
in one pass without a shuffle.

Null and empty texts have no words. A repeated label counts as its most severe. Without any labelled row, or
without a toxic one, nothing is toxic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.llm.common import Batches, map_batches, packed, unpacked
from geolink.llm.decontam import words
from geolink.operators.staging import stage_table

#: Words of a section, and words from one section to the next.
SECTION = 60
STEP = 20
#: Times that a word counts in a section.
TIMES = 2
#: Labelled rows that the model is fitted on; sections of each that are read, and that are sent.
SAMPLE = 10_000
FIT_SECTIONS = 256
KEPT = 32
#: Features of the model: those that stand in so many toxic texts and whose log odds ratio is so many
#: standard errors above zero, and of them the most telling ``FEATURES``.
LEAST = 2
ERRORS = 2.0
FEATURES = 6000
#: Bytes of the beginnings of words that are features.
BEGINNINGS = range(4, 13)
#: Times that the worst sections of toxic texts are found.
ROUNDS = 3
#: Words whose features a worker remembers.
MEMORY = 200_000
#: A text is rejected from this probability of grade 1 or more.
LIMIT = 0.25


def features_of(word: bytes) -> list[bytes]:
    """The word itself, and its beginnings, each with a mark in front."""
    return [word, *(b"^" + word[:n] for n in BEGINNINGS if n <= len(word))]


def section_count(count: int) -> int:
    """Sections of a text of so many words."""
    return max(1, -(-(count - SECTION) // STEP) + 1)


def section_sums(places: np.ndarray, before: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of the values of the words of each section.

    Words stand at ``places``. A word does not count in sections from ``before`` or further, where the
    same word stood ``TIMES`` words of its kind ago, or -1.
    """
    total = section_count(count)
    # The first section that begins after both.
    first = np.maximum((np.maximum(places - SECTION, before) + STEP) // STEP, 0)
    last = np.minimum(places // STEP, total - 1)
    counted = first <= last
    steps = np.bincount(first[counted], values[counted], total + 1)
    steps -= np.bincount(last[counted] + 1, values[counted], total + 1)
    return np.cumsum(steps[:total])


class Memory(dict):
    """What words seen lately are worth: ``worth`` of their known features."""

    def __init__(self, known, worth):
        super().__init__()
        self.known, self.worth = known, worth

    def __missing__(self, word: bytes):
        found = self.worth(f for f in features_of(word) if f in self.known)
        if len(self) >= MEMORY:
            self.clear()
        self[word] = found
        return found


class Model:
    """Weights of the features, and the thresholds between grades."""

    def __init__(self, weights: dict[bytes, float], thresholds: tuple[float, ...]):
        self.weights, self.thresholds = weights, thresholds
        self.memory = Memory(weights, lambda found: sum(weights[f] for f in found))

    def __reduce__(self):
        return Model, (self.weights, self.thresholds)

    def score(self, text: bytes | None) -> float:
        """The score of the worst section."""
        found = words(text)
        memory = self.memory
        places = [i for i, w in enumerate(found) if memory[w]]
        if not places:
            return 0.0
        seen: dict[bytes, list[int]] = {}
        before, values = [], []
        for i in places:
            word = found[i]
            own = seen.setdefault(word, [])
            before.append(own[-TIMES] if len(own) >= TIMES else -1)
            values.append(memory[word])
            own.append(i)
        return float(section_sums(np.array(places), np.array(before), np.array(values), len(found)).max())

    def above(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` for each threshold."""
        return 1 / (1 + np.exp(np.array(self.thresholds) - scores[:, None]))


def severity_grade(toxic: str = "toxic", quality: str = "quality") -> Column:
    return F.when(F.col(toxic) != 1, 0).when(F.col(quality) == 0, 2).when(F.col(toxic) == 1, 1)


def fit_sections(text: bytes | None) -> list[dict[bytes, int]]:
    """The words of sections of the text, and how often they count: all, or ``FIT_SECTIONS`` evenly spread."""
    found = words(text)
    total = section_count(len(found))
    chosen = range(total) if total <= FIT_SECTIONS else [i * total // FIT_SECTIONS for i in range(FIT_SECTIONS)]
    counts = [Counter(found[i * STEP : i * STEP + SECTION]) for i in chosen]
    return [{w: min(n, TIMES) for w, n in c.items()} for c in counts]


def feature_shares(text: bytes | None) -> dict[bytes, float]:
    """By feature, the share of the text's sections that have it."""
    sections = fit_sections(text)
    held: Counter = Counter()
    for section in sections:
        held.update({f for w in section for f in features_of(w)})
    return {f: n / len(sections) for f, n in held.items()}


#: Shares are added up as whole numbers, so that the order of rows does not matter.
_UNIT = 1 << 20


def choose_features(sample: DataFrame) -> dict[bytes, float]:
    """The features that tell most for severity and their log odds ratios, by shares of sections.

    At most ``FEATURES`` rows reach the driver.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sums: dict[bytes, list[int]] = {}
            for text, grade in zip(batch["body"].to_pylist(), batch["grade"].to_pylist(), strict=True):
                for f, share in feature_shares(text).items():
                    own = sums.setdefault(f, [0, 0, 0])
                    own[grade > 0] += round(share * _UNIT)
                    own[2] += grade > 0
            clean, toxic, texts = zip(*sums.values(), strict=True) if sums else ((), (), ())
            columns = [pa.array(list(sums), pa.binary()), *(pa.array(c, pa.int64()) for c in (clean, toxic, texts))]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "clean", "toxic", "texts"])

    m, n = sample.agg(F.count(F.when(F.col("grade") > 0, 1)), F.count(F.when(F.col("grade") == 0, 1))).first()
    found = map_batches(sample, run, "feature binary, clean bigint, toxic bigint, texts bigint")
    sums = found.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("clean", "toxic", "texts")])
    a, b = (F.col(c) / _UNIT + 0.5 for c in ("toxic", "clean"))
    odds = F.log(a / (m + 1.0 - a + 0.5)) - F.log(b / (n + 1.0 - b + 0.5))
    errors = odds / F.sqrt(1 / a + 1 / b)
    telling = sums.filter(F.col("texts") >= LEAST).select("feature", odds.alias("odds"), errors.alias("errors"))
    best = telling.filter(F.col("errors") >= ERRORS).orderBy(F.desc("errors"), "feature").limit(FEATURES)
    return {bytes(r.feature): r.odds for r in best.collect()}


class Sections:
    """Sections of labelled texts as sparse rows: feature ``at`` has ``counts``, in the ``row``."""

    def __init__(self, texts: Iterable[tuple[int, int, list[tuple[list[int], list[int]]]]]):
        """Per text its grade, how many sections it has beside those given, and the given ones."""
        grades, owners, rows, at, counts = [], [], [], [], []
        self.others = 0
        for grade, others, sections in texts:
            for features, numbers in sections:
                rows += [len(owners)] * len(features)
                owners.append(len(grades))
                at += features
                counts += numbers
            grades.append(grade)
            # What is not given of a clean text counts as clean, without features.
            self.others += others if grade == 0 else 0
        self.grades, self.owners = np.array(grades, np.int64), np.array(owners, np.int64)
        self.rows, self.at, self.counts = np.array(rows, np.int64), np.array(at, np.int64), np.array(counts, np.float64)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.at] * self.counts, len(self.owners))

    def worst(self, weights: np.ndarray) -> np.ndarray:
        """All sections of clean texts, and of each toxic one the one with the highest score."""
        scores, grades = self.scores(weights), self.grades[self.owners]
        order = np.lexsort((-scores, self.owners))
        first = order[np.r_[True, np.diff(self.owners[order]) != 0]] if len(order) else order
        return np.sort(np.r_[np.flatnonzero(grades == 0), first[grades[first] > 0]])


def _fitted(data: Sections, chosen: np.ndarray, values: np.ndarray, top: int, steps: int, penalty: float) -> np.ndarray:
    """Weights, first threshold and logarithms of the steps between thresholds; penalised, by Adam."""
    size = len(values) - top
    place = np.full(len(data.owners) + 1, -1)
    place[chosen] = np.arange(len(chosen))
    used = place[data.rows] >= 0
    rows, at, counts = place[data.rows[used]], data.at[used], data.counts[used]
    # One row without features stands for all that were not given.
    grades = np.r_[data.grades[data.owners[chosen]], 0]
    # Clean sections weigh as much as there are clean texts.
    clean = (data.grades == 0).sum() / max((grades[:-1] == 0).sum() + data.others, 1)
    mass = np.where(grades == 0, clean, 1.0) * np.r_[np.ones(len(chosen)), data.others]
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        weights, rises = values[:size], np.exp(values[size + 1 :])
        bounds = np.r_[-np.inf, values[size] + np.r_[0.0, np.cumsum(rises)], np.inf]
        score = np.bincount(rows, weights[at] * counts, len(grades))
        upper, lower = bounds[grades + 1] - score, bounds[grades] - score
        p_up, p_low = (1 / (1 + np.exp(-np.clip(x, -500, 500))) for x in (upper, lower))
        p = np.maximum(p_up - p_low, 1e-12)
        d_up, d_low = mass * p_up * (1 - p_up) / p, mass * p_low * (1 - p_low) / p
        slope = np.empty_like(values)
        slope[:size] = np.bincount(at, (d_up - d_low)[rows] * counts, size) + penalty * weights
        at_bound = np.array([d_low[grades == k + 1].sum() - d_up[grades == k].sum() for k in range(top)])
        slope[size] = at_bound.sum()
        slope[size + 1 :] = np.cumsum(at_bound[::-1])[::-1][1:] * rises
        slope /= mass.sum()
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        values = values - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        values[:size] = np.maximum(values[:size], 0)
    return values


def fit(data: Sections, odds: dict[bytes, float], steps: int = 200, penalty: float = 10.0) -> Model:
    """The model of sections whose features are the keys of ``odds``, in their order."""
    names = list(odds)
    top = int(data.grades.max(initial=0))
    if top == 0 or not names:
        return Model({}, (40.0,))
    n = len(data.grades)
    share = np.array([max((data.grades > k).mean(), 0.5 / n) for k in range(top)])
    start = np.log((1 - share) / share)
    weights = np.array([odds[f] for f in names])
    values = np.r_[np.zeros(len(names)), start[0], np.log(np.maximum(np.diff(start), 0.1))]
    for _ in range(ROUNDS):
        values = _fitted(data, data.worst(weights), values, top, steps, penalty)
        weights = values[: len(names)]
    bounds = values[len(names)] + np.r_[0.0, np.cumsum(np.exp(values[len(names) + 1 :]))]
    kept = {f: w for f, w in zip(names, weights.tolist(), strict=True) if w > 0}
    return Model(kept, tuple(bounds.tolist()))


def chosen_sections(text: bytes | None, memory: Memory, odds: np.ndarray) -> tuple[int, list[tuple[list[int], list[int]]]]:
    """The ``KEPT`` sections with the most odds, as features and counts, and how many others there are."""
    sections = []
    for section in fit_sections(text):
        held: Counter = Counter()
        for word, n in section.items():
            for f in memory[word]:
                held[f] += n
        if held:
            features = sorted(held)
            counts = [held[f] for f in features]
            sections.append((float(odds[features] @ np.array(counts)), features, counts))
    total = len(sections)
    sections = sorted(sections, key=lambda s: -s[0])[:KEPT]
    return max(0, section_count(len(words(text))) - total) + total - len(sections), [s[1:] for s in sections]


def sections_of(sample: DataFrame, odds: dict[bytes, float]) -> Sections:
    """The chosen features of the sampled texts' worst sections, as a bounded number of bytes each."""
    shared = sample.sparkSession.sparkContext.broadcast(odds)

    def run(batches: Batches) -> Batches:
        known = {f: i for i, f in enumerate(shared.value)}
        values = np.array(list(shared.value.values()))
        memory = Memory(known, lambda found: tuple(known[f] for f in found))
        for batch in batches:
            others, sections = [], []
            for text in batch["body"].to_pylist():
                left, found = chosen_sections(text, memory, values)
                others.append(left)
                flat = [x for features, counts in found for x in (len(features), *features, *counts)]
                sections.append(np.array(flat, np.int32).tobytes())
            columns = [batch["draw"], batch["grade"], pa.array(others, pa.int64()), pa.array(sections, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["draw", "grade", "others", "sections"])

    def read(flat: bytes) -> list[tuple[list[int], list[int]]]:
        numbers, out, i = np.frombuffer(flat, np.int32).tolist(), [], 0
        while i < len(numbers):
            n = numbers[i]
            out.append((numbers[i + 1 : i + 1 + n], numbers[i + 1 + n : i + 1 + 2 * n]))
            i += 1 + 2 * n
        return out

    found = map_batches(sample, run, "draw bigint, grade int, others bigint, sections binary")
    return Sections((r.grade, r.others, read(r.sections)) for r in sorted(found.collect(), key=lambda r: r.draw))


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """``draw, grade, body`` of a bounded number of labelled texts; the same id and text is taken once."""
    graded = (
        labels.select(F.col(f"`{id_col}`").alias("label_id"), severity_grade().alias("grade"))
        .filter("label_id is not null and grade is not null")
        .groupBy("label_id")
        .agg(F.max("grade").alias("grade"))
    )
    chosen = graded.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    text = F.col(f"`{text_col}`")
    rows = (
        docs.select(F.col(f"`{id_col}`").alias("label_id"), text.cast("binary").alias("body"))
        .filter(text.isNotNull())
        .join(F.broadcast(chosen), "label_id")
        .withColumn("draw", F.xxhash64("label_id", "body"))
    )
    kept = stage_table(rows.dropDuplicates(["draw"]).select("draw", "grade", "body"), "labelled")
    last = kept.select("draw").orderBy("draw").limit(sample).agg(F.max("draw")).first()[0]
    return kept.filter(F.col("draw") <= (last or 0))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Model:
    """The model of a bounded sample of the labelled rows."""
    rows = sampled(docs, labels, id_col, text_col, sample)
    odds = choose_features(rows)
    return fit(sections_of(rows, odds), odds)


def _scored(docs: DataFrame, model: Model, text_col: str, row: Column) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        own = shared.value
        for batch in batches:
            scores = np.array([own.score(t) for t in batch["text"].to_pylist()], np.float64)
            above = own.above(scores)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    batch["text"].cast(pa.string()),
                    pa.array(above.sum(axis=1)),
                    pa.array(above[:, 0]),
                    pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                ],
                names=["row", "body", "severity", "p_toxic", "grade"],
            )

    df = docs.select(row, F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = df.schema["row"].dataType.simpleString()
    schema = f"row {kind}, body string, severity double, p_toxic double, grade int"
    return map_batches(df, run, schema)


def severities(
    docs: DataFrame,
    model: Model,
    limit: float = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: the id, expected ``severity``, ``p_toxic``, the ``grade`` and ``rejected``."""
    scored = _scored(docs, model, text_col, F.struct(F.col(f"`{id_col}`")).alias("row"))
    return scored.select(
        F.col(f"row.`{id_col}`").alias(id_col),
        "severity",
        "p_toxic",
        "grade",
        (F.col("p_toxic") >= limit).alias("rejected"),
    )


def drop_toxic(
    docs: DataFrame,
    model: Model,
    limit: float = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows and columns of ``docs`` whose probability of being toxic is below the limit."""
    scored = _scored(docs, model, text_col, packed(docs, text_col))
    return unpacked(scored.filter(F.col("p_toxic") < limit), docs, text_col, "body")
