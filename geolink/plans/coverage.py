"""How well coded keys of the cases are covered by a lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.functions.keys import is_filled, prefix, trimmed, zero_pad
from geolink.functions.ratios import pct
from geolink.operators.ranking import top_n_per_group

# Case fields that hold municipality codes, and the state field of each.
MUNICIPALITY_FIELDS = ("ID_MUNICIP", "ID_MN_RESI", "ATE_MUNICI")
STATE_PAIRS = (
    ("ID_MUNICIP", "SG_UF_NOT"),
    ("ID_MN_RESI", "SG_UF"),
    ("ATE_MUNICI", "ATE_UF_HOS"),
)


def key_frequencies(cases: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows per ``(field, codigo)`` of the filled codes, for all fields in one scan."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), trimmed(f).alias("codigo")) for f in fields]
    )
    return (
        cases.select(F.inline(pairs))
        .where("codigo is not null and codigo <> ''")
        .groupBy("field", "codigo")
        .agg(F.count("*").alias("n"))
    )


def flag_known(keys: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Distinct keys with ``known``: whether the lookup has them. No row is multiplied."""
    known = lookup.select(F.col(lookup_key).alias(key)).distinct().withColumn("known", F.lit(True))
    return keys.join(known, key, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def key_coverage(
    cases: DataFrame,
    lookup: DataFrame,
    fields: Sequence[str] = MUNICIPALITY_FIELDS,
    lookup_key: str = "municipio_codigo_6",
) -> DataFrame:
    """Per field: filled rows, distinct codes, and distinct codes with and without a match."""
    flagged = flag_known(key_frequencies(cases, fields), lookup, "codigo", lookup_key)
    found = flagged.select("field", "codigo", "n", "known")
    # One row of nothing per field, so that a field without any code is reported with zeros.
    every = cases.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"),
        F.lit(None).cast("string").alias("codigo"),
        F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("boolean").alias("known"),
    )
    return (
        found.unionAll(every)
        .groupBy("field")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count("codigo").alias("n_distinct"),
            F.count_if("known").alias("n_matched"),
            F.count_if(~F.col("known")).alias("n_unmatched"),
        )
    )


def unmatched_keys(
    cases: DataFrame,
    lookup: DataFrame,
    fields: Sequence[str] = MUNICIPALITY_FIELDS,
    lookup_key: str = "municipio_codigo_6",
    n: int = 50,
) -> DataFrame:
    """The first ``n`` codes per field, in code order, that the lookup lacks."""
    keys = key_frequencies(cases, fields).select("field", "codigo")
    known = lookup.select(F.col(lookup_key).alias("codigo"))
    lacking = keys.join(known, "codigo", "left_anti").select("field", "codigo")
    return top_n_per_group(lacking, "field", n, ascending=["codigo"])


def state_coherence(
    cases: DataFrame, pairs: Sequence[tuple[str, str]] = STATE_PAIRS
) -> DataFrame:
    """Per (municipality, state) pair: comparable rows, and those whose states differ."""
    counts, rows = [], []
    for i, (municipality, state) in enumerate(pairs):
        comparable = is_filled(municipality) & is_filled(state)
        differs = prefix(trimmed(municipality), 2) != zero_pad(trimmed(state), 2)
        counts += [
            F.count_if(comparable).alias(f"c{i}"),
            F.count_if(comparable & differs).alias(f"d{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(municipality).alias("municipality_field"),
                F.lit(state).alias("state_field"),
                F.col(f"c{i}").alias("n_comparable"),
                F.col(f"d{i}").alias("n_inconsistent"),
            )
        )
    return cases.agg(*counts).select(F.inline(F.array(*rows)))


def coverage_of_keys(wanted: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """One row: distinct wanted keys, how many are available or not, and the percentage."""
    flagged = flag_known(wanted.select(key).distinct(), available, key, key)
    counted = flagged.agg(
        F.count("*").alias("n_total"),
        F.count_if("known").alias("n_matched"),
        F.count_if(~F.col("known")).alias("n_unmatched"),
    )
    return counted.withColumn("pct_matched", pct("n_matched", "n_total"))
