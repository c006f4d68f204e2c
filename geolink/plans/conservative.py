"""Conservative locations: a point is kept only near where it should be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.functions.geo import both_present, usable_point
from geolink.functions.keys import (
    LEVEL_MUNICIPALITY,
    LEVEL_NONE,
    LEVEL_POSTAL,
    LEVEL_STATE,
)
from geolink.operators.joins import join_lookups, translate
from geolink.operators.metrics import count_metric, counts, metrics_long
from geolink.operators.projection import keep_existing
from geolink.operators.ranking import order_columns
from geolink.plans.locate import (
    QUALITIES,
    SOURCE_POSTAL,
    SOURCES,
    municipality_side,
    state_side,
    with_location_columns,
)
from geolink.plans.plausibility import DISTANCE, expected_distance

# Fixed value: a point farther than this from its municipality is not kept.
KEEP_KM = 25.0

# Rules, and the quality of a kept point.
RULE_KEEP = "manter_cep"
RULE_MUNICIPALITY = "fallback_municipio"
RULE_STATE = "fallback_uf"
RULE_LEVELS = {
    RULE_KEEP: LEVEL_POSTAL,
    RULE_MUNICIPALITY: LEVEL_MUNICIPALITY,
    RULE_STATE: LEVEL_STATE,
}
QUALITY_KEPT = "aproximado_por_cep_validado"

# Output columns, in output order.
SAMPLE_COLUMNS = [
    "cnes_codigo",
    "cod_cep",
    "cep_limpo",
    "municipio_codigo_6",
    "municipio_nome",
    "uf_codigo",
    "uf_sigla",
    "latitude_cep_original",
    "longitude_cep_original",
    DISTANCE,
    "regra_aplicada",
    "spatial_resolution_original",
    "spatial_resolution_final",
    "latitude",
    "longitude",
    "spatial_source",
    "geocode_quality",
]


def conservative_locations(
    located: DataFrame,
    territory: DataFrame,
    keep_km: float = KEEP_KM,
    require_origin: str | None = None,
) -> DataFrame:
    """Rebuild locations with an audit trail and the rule that decided each.

    By default only the distance decides, so a municipal centroid, at distance zero, is kept too.
    With ``require_origin`` a point must also come from that level to be kept.
    """
    clean = with_location_columns(located)
    df = join_lookups(clean, municipality_side(clean, territory), state_side(territory)).withColumns(
        {
            DISTANCE: expected_distance(),
            "latitude_cep_original": F.col("latitude"),
            "longitude_cep_original": F.col("longitude"),
            "spatial_resolution_original": F.col("spatial_resolution_final"),
            "spatial_source_original": F.col("spatial_source"),
            "geocode_quality_original": F.col("geocode_quality"),
        }
    )
    keep = both_present("latitude", "longitude") & F.coalesce(
        F.col(DISTANCE) <= F.lit(float(keep_km)), F.lit(False)
    )
    if require_origin is not None:
        keep = keep & F.coalesce(F.col("spatial_resolution_final") == require_origin, F.lit(False))
    points = {
        RULE_KEEP: F.when(keep, usable_point(F.col("latitude"), F.col("longitude"))),
        RULE_MUNICIPALITY: usable_point(F.col("centroide_lat"), F.col("centroide_lon")),
        RULE_STATE: usable_point(F.col("uf_lat"), F.col("uf_lon")),
    }
    rule = F.coalesce(*[F.when(p.isNotNull(), F.lit(name)) for name, p in points.items()])
    kept = F.col("regra_aplicada") == RULE_KEEP
    level = translate(F.col("regra_aplicada"), RULE_LEVELS)
    return (
        df.withColumns({"regra_aplicada": rule, "_best": F.coalesce(*points.values())})
        .withColumns(
            {
                "latitude": F.col("_best.lat"),
                "longitude": F.col("_best.lon"),
                "spatial_resolution_final": F.coalesce(level, F.lit(LEVEL_NONE)),
                "spatial_source": F.when(
                    kept, F.coalesce("spatial_source_original", F.lit(SOURCE_POSTAL))
                ).otherwise(translate(level, SOURCES)),
                "geocode_quality": F.when(kept, QUALITY_KEPT).otherwise(
                    translate(level, QUALITIES)
                ),
            }
        )
        .drop("_best", "uf_lat", "uf_lon")
    )


def conservative_order() -> list[Column]:
    """By rule, the farthest first."""
    return [F.col("regra_aplicada").asc_nulls_last(), *order_columns([DISTANCE], ["cnes_codigo"])]


def conservative_sample(rebuilt: DataFrame) -> DataFrame:
    """Every facility by rule, the farthest first."""
    return keep_existing(rebuilt, SAMPLE_COLUMNS).orderBy(*conservative_order())


def conservative_counts() -> list[Column]:
    """The aggregates of ``conservative_metrics``."""
    level, rule = F.col("spatial_resolution_final"), F.col("regra_aplicada")
    return counts(
        n=F.lit(True),
        original_cep=F.col("spatial_resolution_original") == LEVEL_POSTAL,
        cep=level == LEVEL_POSTAL,
        mun=level == LEVEL_MUNICIPALITY,
        uf=level == LEVEL_STATE,
        none=level == LEVEL_NONE,
        r_keep=rule == RULE_KEEP,
        r_mun=rule == RULE_MUNICIPALITY,
        r_uf=rule == RULE_STATE,
    )


def conservative_summary(rebuilt: DataFrame) -> DataFrame:
    """Facilities by original level, final level and rule."""
    return conservative_metrics(rebuilt.agg(*conservative_counts()))


def conservative_metrics(row: DataFrame) -> DataFrame:
    """The summary of one row of ``conservative_counts``."""
    n = F.col("n")
    return metrics_long(
        row,
        [
            count_metric("coverage", "facilities", n),
            count_metric("coverage", "original_cep", F.col("original_cep"), n),
            count_metric("level", LEVEL_POSTAL, F.col("cep"), n),
            count_metric("level", LEVEL_MUNICIPALITY, F.col("mun"), n),
            count_metric("level", LEVEL_STATE, F.col("uf"), n),
            count_metric("level", LEVEL_NONE, F.col("none"), n),
            count_metric("rule", RULE_KEEP, F.col("r_keep"), n),
            count_metric("rule", RULE_MUNICIPALITY, F.col("r_mun"), n),
            count_metric("rule", RULE_STATE, F.col("r_uf"), n),
        ],
    )
