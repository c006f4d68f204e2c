"""Mixing sources to target weights by capped water-filling.

Each source asks for its weight's part of a budget of words. A source holds so many words, and may be
repeated ``epochs`` times at most: where its part is more than that, it is clamped there, and the excess
goes to the other sources by their weights, until none is above. That is a level: each source gets the
lesser of its cap and weight * level. The level is raised round by round; a round is one aggregate over
the table of sources, of which three numbers reach the driver.

A source is then taken as often as its target holds it whole; the rest is a fractional repetition. For it
the documents of a source are ordered by a seeded hash of their id (of the text, without an id), and the
first ones are taken once more until the rest is used up. At the edge stands one hash: its document, or all
rows that share it, evenly, is taken in part, so that a source's words come within one word for each such
row of the target. The edge is found by two histograms of the hash, each narrowing it 4096-fold, and by a
running sum over the hashes that are left; hashes are added up first, so that repeated rows are one.

Everything is DataFrame expressions. Sources are joined as lookups of a measured size; beyond the bound by
a shuffle join that adaptive execution can split.

A null text has no words. A null source is a source, the last one. A source without words has target 0. Rows
that repeat are documents each. The same rows and seed give the same mix, whatever their order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geolink.operators.joins import Side, sized
from geolink.operators.ranking import numbered, order_columns
from geolink.operators.staging import stage_table

#: Weights of the sources in order, over and over; the budget as a part of all words; the cap.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 13
#: Hexadecimal digits of the hash that order documents, and those that one histogram narrows by.
DIGITS = 15
STEP = 3


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_: Column, text: Column, seed: int) -> Column:
    """A number of ``DIGITS`` hexadecimal digits that depends on the seed and the id."""
    known = F.coalesce(id_.cast("string"), F.concat(F.lit("text:"), text), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), known)), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def records(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``id, source, key, size, draw``; the key tells sources apart and is never null."""
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")).alias("key"),
        words_in(text).alias("size"),
        draw(F.col(f"`{id_col}`"), text, seed).alias("draw"),
    )


def cyclic_weights(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Sources with ``weight``: the given ones in turn, by the order of the sources, null last."""
    place = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    placed = numbered(sources, "place", order_columns(ascending=["source"]))
    return placed.withColumn("weight", F.get(cycle, place)).drop("place")


def water_filled(sources: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Sources (``source_size, weight``) with ``target``: the budget by weight, no source above its cap."""
    cap = F.col("source_size") * epochs
    words, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (words or 0)
    level, clamped = 0.0, 0
    while weight:
        raised = (budget - clamped) / weight
        if raised <= level:
            break
        level = raised
        full = cap <= F.col("weight") * level
        clamped, weight = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return sources.withColumn("target", target)


def _narrowed(docs: DataFrame, edges: DataFrame, digits: int) -> DataFrame:
    """Per source the first ``digits`` of the hash at the edge, and what is left there of ``rest``.

    ``docs`` are the rows in question: at most 16**STEP different beginnings for each source.
    """
    begin = F.shiftright("draw", 4 * (DIGITS - digits))
    sums = docs.groupBy("key", begin.alias("edge")).agg(F.sum("size").alias("held"))
    so_far = W.partitionBy("key").orderBy("edge").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = sums.withColumn("upto", F.sum("held").over(so_far))
    [(edges, hint)] = sized(Side(edges, ["key"]))
    at = running.join(hint(edges.select("key", "rest")), "key")
    at = at.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("held") <= F.col("rest")))
    rest = F.col("rest") - F.col("upto") + F.col("held")
    return stage_table(at.select("key", "edge", rest.alias("rest"), "held"), "edges")


def edges_of(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source with a rest: the hash at the ``edge``, the words ``held`` there, and what is taken of them."""
    edges = _narrowed(docs, sources.filter("rest > 0").select("key", "rest"), STEP)
    for digits in (STEP, 2 * STEP):
        [(known, hint)] = sized(Side(edges, ["key"]))
        begin = F.shiftright("draw", 4 * (DIGITS - digits))
        near = docs.withColumn("edge", begin).join(hint(known.select("key", "edge")), ["key", "edge"])
        edges = _narrowed(near.select("key", "draw", "size"), edges, 2 * STEP if digits == STEP else DIGITS)
    return edges


def mixed(
    docs: DataFrame,
    weights: Sequence[int] | DataFrame = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per document: id, ``source``, ``size``, its source's ``source_size`` and ``target``, how often it is
    taken ``whole``, and the words ``taken``, repetitions counted.

    ``weights`` are given in turn to the sources in their order, or come as a table ``source, weight``
    of whole numbers; a source that it does not name weighs nothing.
    """
    found = stage_table(records(docs, seed, id_col, text_col, source_col), "records")
    sources = found.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    if isinstance(weights, DataFrame):
        given = weights.select(
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
            F.col("weight").cast("long"),
        )
        sources = sources.join(given, "key", "left").fillna(0, ["weight"])
    else:
        sources = cyclic_weights(sources, weights)
    sources = water_filled(stage_table(sources, "sources"), share, epochs)
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("wanted div source_size")).otherwise(0).cast("int")
    sources = sources.withColumn("wanted", wanted).withColumn("whole", whole)
    rest = F.col("wanted") - F.col("whole") * F.col("source_size")
    sources = stage_table(sources.withColumn("rest", rest).drop("source", "wanted"), "sources")
    edges = edges_of(found, sources).select("key", "edge", "held", F.col("rest").alias("part"))
    [(lookup, hint)] = sized(Side(sources.drop("rest").join(edges, "key", "left"), ["key"]))
    more = (
        F.when(F.col("draw") < F.col("edge"), F.col("size"))
        .when(F.col("draw") == F.col("edge"), F.expr("size * part div held"))
        .otherwise(0)
    )
    return found.join(hint(lookup), "key").select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        "whole",
        (F.col("size") * F.col("whole") + more).cast("long").alias("taken"),
    )
