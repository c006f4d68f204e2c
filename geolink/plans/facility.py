"""Facility lookups: from a raw registry to one validated row per facility that the cases name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.functions.geo import both_present
from geolink.functions.keys import (
    LEVEL_MUNICIPALITY,
    LEVEL_NONE,
    LEVEL_POSTAL,
    LEVEL_STATE,
    is_filled,
    is_municipality6,
    is_postal_code,
    is_state2,
    level_available,
    only_digits,
    or_empty,
    prefix,
    stripped,
    to_number,
    trimmed,
)
from geolink.functions.ratios import banded, pct, pct_half_up
from geolink.operators.dedupe import first_filled_per_key, keep_first
from geolink.operators.joins import Side, broadcast_within, measure
from geolink.operators.metrics import count_metric, metrics_long, verdict_metric
from geolink.operators.projection import (
    keep_existing,
    pick_column,
    require_columns,
    with_constants,
    with_defaults,
)
from geolink.operators.ranking import top_n
from geolink.operators.staging import stage_table
from geolink.plans.coverage import coverage_of_keys

# Registry columns in use, and their names in the lookup.
REGISTRY_COLUMNS = [
    "CNES",
    "CODUFMUN",
    "COD_CEP",
    "TP_UNID",
    "TPGESTAO",
    "ESFERA_A",
    "NAT_JUR",
    "COMPETEN",
]
ADMINISTRATIVE_NAMES = {
    "TP_UNID": "tp_unid",
    "TPGESTAO": "tpgestao",
    "ESFERA_A": "esfera_a",
    "NAT_JUR": "nat_jur",
    "COMPETEN": "competen",
}
# Output columns, in output order.
LOOKUP_COLUMNS = [
    "cnes_codigo",
    "cod_cep",
    "cep_limpo",
    "cep_valido",
    "codufmun",
    "municipio_codigo_6",
    "municipio_valido",
    "uf_codigo",
    "uf_valida",
    "tp_unid",
    "tpgestao",
    "esfera_a",
    "nat_jur",
    "competen",
    "spatial_resolution_available",
    "spatial_resolution_target",
    "fallback_rule",
    "cnes_competencia",
    "source_system",
    "lookup_scope",
]

# Provenance.
TARGET_LEVEL = "cep"
FALLBACK_RULE = "cep->municipio->uf"
PERIOD = "2026-01"
SOURCE_SYSTEM = "CNES / DATASUS / ST"
LOOKUP_SCOPE = "CNES presentes no SINAN meningite"

# Candidate column names of the minimal lookup.
KEY_CANDIDATES = ["CNES", "CO_CNES"]
NAME_CANDIDATES = [
    "NOME_FANTASIA",
    "NO_FANTASIA",
    "NO_FANTASIA_ESTAB",
    "NO_RAZAO_SOCIAL",
    "NO_RAZAO",
]
LATITUDE_CANDIDATES = ["NU_LATITUDE", "LATITUDE", "VL_LATITUDE"]
LONGITUDE_CANDIDATES = ["NU_LONGITUDE", "LONGITUDE", "VL_LONGITUDE"]

# Lower bounds of the verdicts, in percent.
POSTAL_BANDS = ((50.0, "usable"), (80.0, "strong"))
MUNICIPALITY_BANDS = ((80.0, "good"), (95.0, "excellent"))


def case_facilities(cases: DataFrame, field: str = "ID_UNIDADE") -> DataFrame:
    """Distinct facility keys that the cases name, as ``CNES``."""
    return cases.where(is_filled(field)).select(stripped(trimmed(field)).alias("CNES")).distinct()


def consolidate_registry(
    registry: DataFrame, cases: DataFrame, ordinal: Column | str = "ord"
) -> DataFrame:
    """One row per registry facility that the cases name, each column its first filled value.

    The registry meets the case keys before its aggregate, so that rows of other facilities are not
    shuffled. The distinct keys are staged, measured, and broadcast within the bound of ``joins.sized``;
    beyond it the semi-join is a shuffle join. Their size also bounds the ordinals of the first filled
    values, at most one per key and column. The aggregate absorbs facilities with very many rows map-side.
    """
    require_columns(registry, ["CNES"])
    if isinstance(ordinal, str):
        ordinal = F.col(ordinal)
    rows = registry.withColumns({"CNES": stripped("CNES"), "_ord": ordinal})
    rows = keep_existing(rows, [*REGISTRY_COLUMNS, "_ord"]).where("CNES is not null")
    wanted = stage_table(case_facilities(cases), "case-facilities")
    [(size, _)] = measure([Side(wanted, ["CNES"], wanted)])
    rows = rows.join(broadcast_within(size)(wanted), "CNES", "left_semi")
    # A key counts for 32 bytes or more; beside it stand an ordinal, an array and a flag for each column.
    slots = len(rows.columns)
    of_firsts = slots * size * (1 + (48 + slots) // 32)
    return first_filled_per_key(rows, "CNES", "_ord", broadcast_within(of_firsts)).drop("_ord")


def _with_location_codes(consolidated: DataFrame, municipality_flag: str) -> DataFrame:
    """Cleaned postal, municipality and state codes with their validity flags."""
    base = with_defaults(consolidated, {"COD_CEP": ("string", ""), "CODUFMUN": ("string", "")})
    return (
        base.withColumns(
            {
                "cnes_codigo": F.col("CNES"),
                "cod_cep": or_empty(stripped("COD_CEP")),
                "codufmun": or_empty(stripped("CODUFMUN")),
            }
        )
        .withColumns(
            {
                "cep_limpo": only_digits("cod_cep"),
                "municipio_codigo_6": prefix(only_digits("codufmun"), 6),
            }
        )
        .withColumn("uf_codigo", prefix("municipio_codigo_6", 2))
        .withColumns(
            {
                "cep_valido": is_postal_code("cep_limpo"),
                municipality_flag: is_municipality6("municipio_codigo_6"),
                "uf_valida": is_state2("uf_codigo"),
            }
        )
    )


def facility_lookup(
    registry: DataFrame,
    cases: DataFrame,
    ordinal: Column | str = "ord",
    period: str = PERIOD,
    source_system: str = SOURCE_SYSTEM,
    lookup_scope: str = LOOKUP_SCOPE,
) -> DataFrame:
    """The facility lookup: validated codes, the best level they allow, and provenance."""
    out = _with_location_codes(consolidate_registry(registry, cases, ordinal), "municipio_valido")
    out = out.withColumn(
        "spatial_resolution_available",
        level_available(F.col("cep_valido"), F.col("municipio_valido"), F.col("uf_valida")),
    ).withColumnsRenamed(ADMINISTRATIVE_NAMES)
    out = with_constants(
        out,
        {
            "spatial_resolution_target": TARGET_LEVEL,
            "fallback_rule": FALLBACK_RULE,
            "cnes_competencia": period,
            "source_system": source_system,
            "lookup_scope": lookup_scope,
        },
    )
    return keep_existing(out, LOOKUP_COLUMNS)


def facility_diagnosis(
    registry: DataFrame, cases: DataFrame, ordinal: Column | str = "ord"
) -> DataFrame:
    """Code quality per facility, before any lookup is built."""
    out = _with_location_codes(consolidate_registry(registry, cases, ordinal), "municipio6_valido")
    out = out.withColumn(
        "spatial_resolution_potencial",
        level_available(F.col("cep_valido"), F.col("municipio6_valido"), F.col("uf_valida")),
    )
    return keep_existing(
        out,
        [
            "cnes_codigo",
            "cod_cep",
            "cep_limpo",
            "cep_valido",
            "codufmun",
            "municipio_codigo_6",
            "municipio6_valido",
            "uf_codigo",
            "uf_valida",
            "spatial_resolution_potencial",
            *ADMINISTRATIVE_NAMES,
        ],
    )


def diagnosis_summary(diagnosis: DataFrame) -> DataFrame:
    """Code quality, sharing of postal codes, levels and verdicts as metrics.

    Everything comes from one aggregate per postal code: its rows count the distinct codes, its
    sums the facilities.
    """
    level = F.col("spatial_resolution_potencial")
    flags = {
        "n": F.lit(True),
        "cep_filled": is_filled("cod_cep"),
        "cep_valid": F.col("cep_valido"),
        "mun_filled": is_filled("codufmun"),
        "mun_valid": F.col("municipio6_valido"),
        "uf_valid": F.col("uf_valida"),
        "lvl_cep": level == LEVEL_POSTAL,
        "lvl_mun": level == LEVEL_MUNICIPALITY,
        "lvl_uf": level == LEVEL_STATE,
        "lvl_none": level == LEVEL_NONE,
    }
    per_code = (
        diagnosis.withColumn("_code", F.when(F.col("cep_valido"), F.col("cep_limpo")))
        .groupBy("_code")
        .agg(*[F.count_if(c).alias(name) for name, c in flags.items()])
    )
    totals = per_code.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags],
        F.count("_code").alias("cep_unique"),
        F.count_if(F.col("_code").isNotNull() & (F.col("n") > 1)).alias("cep_shared"),
    )
    n = F.col("n")
    postal, municipality, levels = "postal_code", "municipality", "level"
    return metrics_long(
        totals,
        [
            count_metric(postal, "facilities", n),
            count_metric(postal, "filled", F.col("cep_filled"), n),
            count_metric(postal, "valid", F.col("cep_valid"), n),
            count_metric(postal, "valid_unique", F.col("cep_unique")),
            count_metric(postal, "valid_shared", F.col("cep_shared")),
            count_metric(municipality, "filled", F.col("mun_filled"), n),
            count_metric(municipality, "valid", F.col("mun_valid"), n),
            count_metric(municipality, "state_valid", F.col("uf_valid"), n),
            count_metric(levels, LEVEL_POSTAL, F.col("lvl_cep"), n),
            count_metric(levels, LEVEL_MUNICIPALITY, F.col("lvl_mun"), n),
            count_metric(levels, LEVEL_STATE, F.col("lvl_uf"), n),
            count_metric(levels, LEVEL_NONE, F.col("lvl_none"), n),
            verdict_metric(
                "verdict", "postal_code", banded(pct("cep_valid", n), "weak", *POSTAL_BANDS)
            ),
            verdict_metric(
                "verdict",
                "municipality",
                banded(pct("mun_valid", n), "caution", *MUNICIPALITY_BANDS),
            ),
        ],
    )


def registry_coverage(registry: DataFrame, cases: DataFrame) -> DataFrame:
    """How many of the facilities that the cases name the registry has."""
    available = registry.select(stripped("CNES").alias("CNES"))
    return coverage_of_keys(case_facilities(cases), available, "CNES")


def registry_coverage_metrics(registry: DataFrame, cases: DataFrame) -> DataFrame:
    """The same as metrics, to stack with the diagnosis summary."""
    section, total = "coverage", F.col("n_total")
    return metrics_long(
        registry_coverage(registry, cases),
        [
            count_metric(section, "case_facilities", total),
            count_metric(section, "matched", F.col("n_matched"), total),
            count_metric(section, "unmatched", F.col("n_unmatched")),
        ],
    )


def most_frequent(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """The most frequent values, ties in value order; missing counts as the empty text."""
    counted = df.groupBy(or_empty(column).alias(column)).agg(F.count("*").alias("n"))
    return top_n(counted, n, descending=["n"], ascending=[column])


def minimal_lookup(registry: DataFrame, order: Sequence[str] = ("ord",)) -> DataFrame:
    """Facility key, name and coordinates from a registry whose column names vary.

    The first row per facility in ``order`` is kept. A registry without coordinates is an error.
    """
    key = pick_column(registry, KEY_CANDIDATES)
    name = pick_column(registry, NAME_CANDIDATES, required=False)
    lat = pick_column(registry, LATITUDE_CANDIDATES, required=False)
    lon = pick_column(registry, LONGITUDE_CANDIDATES, required=False)
    if lat is None or lon is None:
        raise ValueError(f"no coordinate columns among {registry.columns}")
    projected = registry.select(
        stripped(key).alias("cnes_codigo"),
        (stripped(name) if name else F.lit(None).cast("string")).alias("nome_unidade"),
        to_number(lat).alias("latitude"),
        to_number(lon).alias("longitude"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    ).where("cnes_codigo is not null and cnes_codigo <> ''")
    ordinals = [f"_o{i}" for i in range(len(order))]
    return keep_first(projected, ["cnes_codigo"], *ordinals).drop(*ordinals)


def minimal_lookup_completeness(lookup: DataFrame) -> DataFrame:
    """One row: facilities with and without coordinates; sums of nothing are null."""
    located = both_present("latitude", "longitude")
    counted = lookup.agg(
        F.count("*").alias("total_unidades"),
        F.sum(located.cast("long")).alias("com_coordenada"),
        F.sum((~located).cast("long")).alias("sem_coordenada"),
    )
    return counted.withColumn("pct_com_coordenada", pct_half_up("com_coordenada", "total_unidades"))


def _case_key_counts(cases: DataFrame, field: str) -> DataFrame:
    return (
        cases.where(is_filled(field))
        .groupBy(trimmed(field).alias("cnes_codigo"))
        .agg(F.count("*").alias("n"))
    )


def minimal_lookup_coverage(
    cases: DataFrame, lookup: DataFrame, field: str = "ID_UNIDADE"
) -> DataFrame:
    """One row: case rows with a facility key, distinct keys, and how many of them match."""
    flagged = _case_key_counts(cases, field).join(
        lookup.select(
            "cnes_codigo",
            F.lit(True).alias("known"),
            both_present("latitude", "longitude").alias("located"),
        ),
        "cnes_codigo",
        "left",
    )
    return flagged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.count_if("known").alias("n_matched"),
        F.count_if(F.col("known") & F.col("located")).alias("n_matched_with_coord"),
        F.count_if(F.col("known").isNull()).alias("n_unmatched"),
    )


def minimal_lookup_unmatched(
    cases: DataFrame, lookup: DataFrame, field: str = "ID_UNIDADE", n: int = 50
) -> DataFrame:
    """The first ``n`` facility keys, in key order, that the lookup lacks."""
    keys = _case_key_counts(cases, field).select("cnes_codigo")
    lacking = keys.join(lookup.select("cnes_codigo"), "cnes_codigo", "left_anti")
    return top_n(lacking, n, ascending=["cnes_codigo"])
