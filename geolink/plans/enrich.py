"""The enriched case table: cases with three territorial roles and their facility."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.functions.geo import both_present
from geolink.functions.keys import trimmed
from geolink.operators.bucketed import join_bucketed
from geolink.operators.joins import Side, sized
from geolink.operators.metrics import count_metric, metrics_long
from geolink.operators.projection import with_constants, with_defaults, with_null_texts
from geolink.operators.ranking import top_n

# Case field and column prefix per territorial role.
ROLES = {
    "ID_MN_RESI": "municipio_residencia_",
    "ID_MUNICIP": "municipio_notificacao_",
    "ATE_MUNICI": "municipio_hospital_",
}

# Lookup columns and their names behind a role prefix.
ROLE_COLUMNS = {
    "municipio_nome": "nome",
    "uf_codigo": "uf_codigo",
    "uf_sigla": "uf_sigla",
    "uf_nome": "uf_nome",
    "centroide_lon": "lon",
    "centroide_lat": "lat",
    "area_km2": "area_km2",
}
FACILITY_COLUMNS = {
    "cod_cep": "unidade_cod_cep",
    "cep_limpo": "unidade_cep_limpo",
    "codufmun": "unidade_codufmun",
    "municipio_codigo_6": "cnes_municipio_codigo_6",
    "uf_codigo": "cnes_uf_codigo",
    "tp_unid": "unidade_tp_unid",
    "tpgestao": "unidade_tpgestao",
    "esfera_a": "unidade_esfera_a",
    "nat_jur": "unidade_nat_jur",
    "competen": "cnes_competen",
    "spatial_resolution_available": "unidade_spatial_resolution_available",
    "spatial_resolution_target": "unidade_spatial_resolution_target",
    "spatial_resolution_final": "unidade_spatial_resolution_final",
    "spatial_source": "unidade_spatial_source",
    "geocode_quality": "unidade_geocode_quality",
    "latitude": "unidade_latitude",
    "longitude": "unidade_longitude",
    "municipio_nome": "unidade_municipio_nome",
    "uf_sigla": "unidade_uf_sigla",
    "uf_nome": "unidade_uf_nome",
}
PROVENANCE = {
    "source_dataset": "SINAN",
    "territorial_lookup_source": "IBGE",
    "unidade_lookup_source": "CNES",
    "integration_layer": "SINAN+IBGE+CNES",
    "spatial_dataset_version": "v1",
}

# Output columns, in output order.
SAMPLE_COLUMNS = [
    "ID_MN_RESI",
    "municipio_residencia_nome",
    "municipio_residencia_uf_sigla",
    "municipio_residencia_lat",
    "municipio_residencia_lon",
    "ID_MUNICIP",
    "municipio_notificacao_nome",
    "municipio_notificacao_uf_sigla",
    "ID_UNIDADE",
    "unidade_cod_cep",
    "unidade_spatial_resolution_final",
    "unidade_latitude",
    "unidade_longitude",
]


def enrich_cases(
    cases: DataFrame,
    territory: DataFrame,
    facilities: DataFrame,
    trim_keys: bool = False,
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """Cases with residence, notification and hospital municipality, facility and provenance.

    Every case row is kept once. Territorial keys are compared as they are unless ``trim_keys``;
    the facility key is always trimmed. Both lookups are measured once (see ``sized``), and within
    the bound the whole plan is one scan of the cases without a shuffle.
    """
    territory, facilities = _lookups(territory, facilities)
    (territory, territory_hint), (facilities, facility_hint) = sized(
        Side(territory, ["municipio_codigo_6"]),
        Side(facilities, ["cnes_codigo"]),
        max_broadcast_bytes=max_broadcast_bytes,
    )

    def link(out: DataFrame, lookup: DataFrame, key: Column, is_facility: bool) -> DataFrame:
        hint = facility_hint if is_facility else territory_hint
        return out.withColumn("_key", key).join(hint(lookup), "_key", "left").drop("_key")

    return _linked(cases, territory, facilities, trim_keys, link)


def enrich_cases_bucketed(
    cases: DataFrame, territory: DataFrame, facilities: DataFrame, trim_keys: bool = False
) -> DataFrame:
    """``enrich_cases`` with lookups of any size, in buckets of their keys (see ``operators.bucketed``).

    No lookup is shuffled: the territory, which three roles use, was so once, when it was written. The
    facility comes from buckets of ``cnes_codigo``, the territory from buckets of ``municipio_codigo_6``.
    """
    territory, facilities = _lookups(territory, facilities)

    def link(out: DataFrame, lookup: DataFrame, key: Column, is_facility: bool) -> DataFrame:
        return join_bucketed(out, lookup, "_key", key, cases)

    return _linked(cases, territory, facilities, trim_keys, link)


def _lookups(territory: DataFrame, facilities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of both lookups that cases get."""
    territory = with_defaults(territory, {"area_km2": ("double", None)}).select(
        "municipio_codigo_6", *ROLE_COLUMNS
    )
    texts = [c for c in FACILITY_COLUMNS if c not in ("latitude", "longitude")]
    return territory, with_null_texts(facilities, texts).select("cnes_codigo", *FACILITY_COLUMNS)


def _linked(
    cases: DataFrame,
    territory: DataFrame,
    facilities: DataFrame,
    trim_keys: bool,
    link: Callable[[DataFrame, DataFrame, Column, bool], DataFrame],
) -> DataFrame:
    # The facility comes first: should its lookup be too large to broadcast, the shuffle then
    # carries the cases without the territorial columns.
    unit = facilities.withColumnsRenamed({"cnes_codigo": "_key", **FACILITY_COLUMNS})
    out = link(cases, unit, trimmed("ID_UNIDADE"), True)
    for field, prefix in ROLES.items():
        names = {c: f"{prefix}{bare}" for c, bare in ROLE_COLUMNS.items()}
        role = territory.withColumnsRenamed({"municipio_codigo_6": "_key", **names})
        key = trimmed(field) if trim_keys else F.col(field).cast("string")
        out = link(out, role, key, False)
    roles = [f"{prefix}{bare}" for prefix in ROLES.values() for bare in ROLE_COLUMNS.values()]
    ordered = out.select(*cases.columns, *roles, *FACILITY_COLUMNS.values())
    return with_constants(ordered, PROVENANCE)


def enriched_summary(enriched: DataFrame) -> DataFrame:
    """Rows, columns and located cases in one pass."""
    row = enriched.agg(
        F.count("*").alias("rows"),
        *[
            F.count_if(both_present(f"{p}lat", f"{p}lon")).alias(name)
            for p, name in (("municipio_residencia_", "residence"), ("municipio_notificacao_", "notification"))
        ],
        F.count_if(both_present("unidade_latitude", "unidade_longitude")).alias("facility"),
    )
    section, rows = "enriched", F.col("rows")
    return metrics_long(
        row,
        [
            count_metric(section, "rows", rows),
            count_metric(section, "columns", F.lit(len(enriched.columns))),
            count_metric(section, "residence_located", F.col("residence")),
            count_metric(section, "notification_located", F.col("notification")),
            count_metric(section, "facility_located", F.col("facility")),
        ],
    )


def enriched_sample(enriched: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first rows by ``key``, with the columns that show the links."""
    return top_n(enriched.select(key, *SAMPLE_COLUMNS), n, ascending=[key])


def first_enriched(
    cases: DataFrame, territory: DataFrame, facilities: DataFrame, key: str, n: int = 10
) -> DataFrame:
    """``enriched_sample`` of cases that are not enriched yet: the joins keep rows, so these come first."""
    first = top_n(cases, n, ascending=[key])
    return enriched_sample(enrich_cases(first, territory, facilities), key, n)
