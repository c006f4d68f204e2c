"""Locations of facilities: postal code, then municipality, then state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.functions.geo import usable_point
from geolink.functions.keys import (
    LEVEL_MUNICIPALITY,
    LEVEL_POSTAL,
    LEVEL_STATE,
    finite,
    only_digits,
    or_empty,
    to_number,
)
from geolink.operators.dedupe import keep_first
from geolink.operators.joins import Side, join_lookups, suffix_clashes, translate
from geolink.operators.metrics import count_metric, counts, metrics_long
from geolink.operators.projection import keep_existing, with_null_texts
from geolink.plans.cache import cached_points

# Source and quality per level.
SOURCE_POSTAL = "nominatim_cep"
SOURCE_MUNICIPALITY = "ibge_municipio_centroid"
SOURCE_STATE = "ibge_uf_centroid"
SOURCES = {
    LEVEL_POSTAL: SOURCE_POSTAL,
    LEVEL_MUNICIPALITY: SOURCE_MUNICIPALITY,
    LEVEL_STATE: SOURCE_STATE,
}
QUALITIES = {
    LEVEL_POSTAL: "aproximado_por_cep",
    LEVEL_MUNICIPALITY: "centroide_municipal",
    LEVEL_STATE: "centroide_uf",
}

# Output columns, in output order.
LOCATED_COLUMNS = [
    "cnes_codigo",
    "cod_cep",
    "cep_limpo",
    "codufmun",
    "municipio_codigo_6",
    "uf_codigo",
    "tp_unid",
    "tpgestao",
    "esfera_a",
    "nat_jur",
    "competen",
    "cep_valido",
    "municipio_valido",
    "uf_valida",
    "spatial_resolution_available",
    "spatial_resolution_target",
    "fallback_rule",
    "cnes_competencia",
    "source_system",
    "lookup_scope",
    "latitude",
    "longitude",
    "spatial_resolution_final",
    "spatial_source",
    "geocode_quality",
    "municipio_nome",
    "uf_sigla",
    "uf_nome",
]

MUNICIPALITY_KEY = ["municipio_codigo_6", "uf_codigo"]


def as_double(df: DataFrame, name: str) -> Column:
    """A column as double: text is parsed, NaN and an absent column are null."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    return to_number(name) if df.schema[name].dataType.typeName() == "string" else finite(name)


def with_clean_codes(df: DataFrame) -> DataFrame:
    """Municipality and state codes with the empty text for null, so that blanks are one key."""
    return df.withColumns({c: or_empty(c) for c in MUNICIPALITY_KEY})


def municipality_centroids(
    territory: DataFrame,
    order: Sequence[str] = ("uf_sigla", "municipio_nome", "municipio_codigo_7"),
) -> DataFrame:
    """Municipalities unique by six-digit code, the first in table order."""
    order = [c for c in order if c in territory.columns]
    clean = with_clean_codes(territory).withColumns(
        {c: as_double(territory, c) for c in ("centroide_lat", "centroide_lon")}
    )
    return keep_first(clean, ["municipio_codigo_6"], *order).select(
        "municipio_codigo_6",
        "municipio_nome",
        "uf_codigo",
        "uf_sigla",
        "uf_nome",
        "centroide_lat",
        "centroide_lon",
    )


def municipality_side(df: DataFrame, territory: DataFrame) -> Side:
    """The expected municipality; names that ``df`` has already get the suffix ``_ibge``."""
    lookup = municipality_centroids(territory)
    return Side(
        suffix_clashes(df, lookup, MUNICIPALITY_KEY, "_ibge"), MUNICIPALITY_KEY, territory
    )


def state_side(territory: DataFrame) -> Side:
    """State centroids ``uf_lat`` and ``uf_lon`` by state code alone, so one row per code."""
    clean = territory.dropna(subset=["uf_codigo", "uf_sigla", "uf_nome"])
    centroids = clean.groupBy("uf_codigo").agg(
        F.avg(as_double(territory, "centroide_lat")).alias("uf_lat"),
        F.avg(as_double(territory, "centroide_lon")).alias("uf_lon"),
    )
    return Side(centroids, ["uf_codigo"], territory)


def locate_facilities(
    facilities: DataFrame,
    cache: DataFrame,
    territory: DataFrame,
    cache_order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Give each facility the best location there is, with its level, source and quality.

    A level counts only if both of its coordinates are known; a failed lookup is no lookup.
    """
    if "cep_limpo" in facilities.columns:
        postal = or_empty("cep_limpo")
    else:
        postal = only_digits("cod_cep") if "cod_cep" in facilities.columns else F.lit("")
    base = with_clean_codes(facilities.withColumn("cep_limpo", postal))
    joined = join_lookups(
        base,
        Side(cached_points(cache, cache_order), ["cep_limpo"], cache),
        municipality_side(base, territory),
        state_side(territory),
    )

    points = {
        LEVEL_POSTAL: usable_point(F.col("cache_lat"), F.col("cache_lon")),
        LEVEL_MUNICIPALITY: usable_point(F.col("centroide_lat"), F.col("centroide_lon")),
        LEVEL_STATE: usable_point(F.col("uf_lat"), F.col("uf_lon")),
    }
    level = F.coalesce(*[F.when(p.isNotNull(), F.lit(name)) for name, p in points.items()])
    best = F.coalesce(*points.values())
    # Where no level applies, an incomplete cached pair is passed on as it is.
    out = joined.withColumns({"_best": best, "spatial_resolution_final": level}).withColumns(
        {
            "latitude": F.coalesce("_best.lat", "cache_lat"),
            "longitude": F.coalesce("_best.lon", "cache_lon"),
            "spatial_source": translate(F.col("spatial_resolution_final"), SOURCES),
            "geocode_quality": translate(F.col("spatial_resolution_final"), QUALITIES),
        }
    )
    return keep_existing(out, LOCATED_COLUMNS)


def location_counts() -> list[Column]:
    """The aggregates of ``location_metrics``."""
    level = F.col("spatial_resolution_final")
    return counts(
        n=F.lit(True),
        cep=level == LEVEL_POSTAL,
        mun=level == LEVEL_MUNICIPALITY,
        uf=level == LEVEL_STATE,
        none=level.isNull(),
    )


def location_summary(located: DataFrame) -> DataFrame:
    """Facilities per level."""
    return location_metrics(located.agg(*location_counts()))


def location_metrics(row: DataFrame) -> DataFrame:
    """The summary of one row of ``location_counts``."""
    section, n = "level", F.col("n")
    return metrics_long(
        row,
        [
            count_metric(section, "facilities", n),
            count_metric(section, LEVEL_POSTAL, F.col("cep"), n),
            count_metric(section, LEVEL_MUNICIPALITY, F.col("mun"), n),
            count_metric(section, LEVEL_STATE, F.col("uf"), n),
            count_metric(section, "none", F.col("none"), n),
        ],
    )


def with_location_columns(located: DataFrame) -> DataFrame:
    """A located table with clean codes, parsed coordinates and every label column present."""
    labels = ["spatial_resolution_final", "spatial_source", "geocode_quality"]
    out = with_clean_codes(with_null_texts(located, labels))
    return out.withColumns({c: as_double(located, c) for c in ("latitude", "longitude")})
