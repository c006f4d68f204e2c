"""How plausible facility locations are: distance to where they should be, and repeated points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolink.functions.geo import both_present, farther_than, haversine_km, rounded
from geolink.functions.keys import LEVEL_MUNICIPALITY, LEVEL_POSTAL, LEVEL_STATE
from geolink.functions.ratios import pct
from geolink.operators.joins import join_lookups
from geolink.operators.metrics import count_metric, metrics_long, verdict_metric
from geolink.operators.projection import keep_existing
from geolink.operators.ranking import order_columns, top_n
from geolink.plans.locate import municipality_side, with_location_columns

# Thresholds.
DISTANCE_THRESHOLDS_KM = (25, 50, 100, 250)
DOWNGRADE_KM = 100
COLLAPSE_SIZES = (10, 25, 50)
ISOLATED_PCT = 5.0

# Names of the distance and of the downgrade flag.
DISTANCE = "dist_km_to_expected_municipio"
CANDIDATE = "candidate_downgrade_to_municipio"

# Output columns, in output order.
TOP_DISTANCE_COLUMNS = [
    "cnes_codigo",
    "municipio_codigo_6",
    "municipio_nome",
    "uf_sigla",
    "latitude",
    "longitude",
    "centroide_lat",
    "centroide_lon",
    "spatial_resolution_final",
    "spatial_source",
    "geocode_quality",
    DISTANCE,
    CANDIDATE,
]
SAMPLE_COLUMNS = [
    "cnes_codigo",
    "cod_cep",
    "cep_limpo",
    "municipio_codigo_6",
    "municipio_nome",
    "uf_codigo",
    "uf_sigla",
    "latitude",
    "longitude",
    "centroide_lat",
    "centroide_lon",
    "spatial_resolution_final",
    "spatial_source",
    "geocode_quality",
    DISTANCE,
    CANDIDATE,
]


def expected_distance() -> Column:
    """Distance from a location to the centroid of the municipality it should be in."""
    return haversine_km("latitude", "longitude", "centroide_lat", "centroide_lon")


def audit_plausibility(
    located: DataFrame,
    territory: DataFrame,
    thresholds_km: Sequence[int] = DISTANCE_THRESHOLDS_KM,
    downgrade_km: float = DOWNGRADE_KM,
) -> DataFrame:
    """Located facilities with distance, threshold flags, rounded point and downgrade flag."""
    far = {f"dist_gt_{km}km": farther_than(DISTANCE, km) for km in thresholds_km}
    candidate = F.coalesce(
        F.col("spatial_resolution_final") == LEVEL_POSTAL, F.lit(False)
    ) & farther_than(DISTANCE, downgrade_km)
    clean = with_location_columns(located)
    joined = join_lookups(clean, municipality_side(clean, territory))
    return joined.withColumn(DISTANCE, expected_distance()).withColumns(
        {
            "has_coord": both_present("latitude", "longitude"),
            "lat_round6": rounded("latitude"),
            "lon_round6": rounded("longitude"),
            **far,
            CANDIDATE: candidate,
        }
    )


def plausibility_order() -> list[Column]:
    """Downgrade candidates and the farthest first."""
    return order_columns([CANDIDATE, DISTANCE], ["cnes_codigo"])


def plausibility_sample(audited: DataFrame) -> DataFrame:
    """Every audited facility, downgrade candidates and the farthest first."""
    return keep_existing(audited, SAMPLE_COLUMNS).orderBy(*plausibility_order())


def top_distances(audited: DataFrame, n: int = 500) -> DataFrame:
    """The facilities farthest from where they should be."""
    return top_n(keep_existing(audited, TOP_DISTANCE_COLUMNS), n, [DISTANCE], ["cnes_codigo"])


def repeated_coordinates(audited: DataFrame) -> DataFrame:
    """Facilities, municipalities and states per rounded point, with one level as an example."""
    point, level = ["lat_round6", "lon_round6"], F.col("spatial_resolution_final")
    example = F.min(F.when(level.isNotNull(), F.struct("cnes_codigo", level.alias("level"))))

    def grouped(df: DataFrame, *keys: str, **more: Column) -> DataFrame:
        sums = [F.sum("n_cnes").alias("n_cnes"), F.min("example").alias("example")]
        return df.groupBy(*point, *keys).agg(*sums, *[c.alias(n) for n, c in more.items()])

    # Distinct counts level by level: each is a count of the rows of the level below, where a plain
    # count of distinct values would multiply every row.
    places = audited.where("has_coord").groupBy(*point, "uf_codigo", "municipio_codigo_6")
    places = places.agg(F.count("cnes_codigo").alias("n_cnes"), example.alias("example"))
    towns = grouped(places, "municipio_codigo_6", **{"uf": F.collect_set("uf_codigo")})
    one = grouped(towns, n_municipios=F.count("municipio_codigo_6"), ufs=F.collect_set("uf"))
    return one.select(
        *point,
        "n_cnes",
        "n_municipios",
        F.size(F.array_distinct(F.flatten("ufs"))).cast("long").alias("n_ufs"),
        F.col("example.level").alias("example_spatial_resolution"),
    )


def top_coordinates(audited: DataFrame, n: int = 200) -> DataFrame:
    """The most repeated points."""
    return top_n(
        repeated_coordinates(audited),
        n,
        ["n_cnes", "n_municipios", "n_ufs"],
        ["lat_round6", "lon_round6"],
    )


def collapse_counts(audited: DataFrame, sizes: Sequence[int] = COLLAPSE_SIZES) -> DataFrame:
    """Points shared by at least so many facilities, per size."""
    sizes_of_points = (
        audited.where("has_coord")
        .groupBy("lat_round6", "lon_round6")
        .agg(F.count("cnes_codigo").alias("n"))
        .agg(*[F.count_if(F.col("n") >= k).alias(f"ge_{k}") for k in sizes])
    )
    rows = [F.struct(F.lit(k).alias("min_size"), F.col(f"ge_{k}").alias("n_points")) for k in sizes]
    return sizes_of_points.select(F.inline(F.array(*rows)))


def plausibility_summary(
    audited: DataFrame,
    thresholds_km: Sequence[int] = DISTANCE_THRESHOLDS_KM,
    sizes: Sequence[int] = COLLAPSE_SIZES,
    isolated_pct: float = ISOLATED_PCT,
) -> DataFrame:
    """Coverage, distances, repeated points, candidates and verdicts as metrics.

    One aggregate per rounded point carries all counts; its rows are the points themselves.
    """
    level = F.col("spatial_resolution_final")
    flags = {
        "n": F.lit(True),
        "located": F.col("has_coord"),
        "lvl_cep": level == LEVEL_POSTAL,
        "lvl_mun": level == LEVEL_MUNICIPALITY,
        "lvl_uf": level == LEVEL_STATE,
        **{f"gt_{km}": F.col(f"dist_gt_{km}km") for km in thresholds_km},
        "beyond": farther_than(DISTANCE, DOWNGRADE_KM),
        "candidates": F.col(CANDIDATE),
        "named": F.col("has_coord") & F.col("cnes_codigo").isNotNull(),
    }
    # Rows without a location share one group, which the map-side aggregate absorbs.
    per_point = audited.groupBy(
        F.when(F.col("has_coord"), F.struct("lat_round6", "lon_round6")).alias("point")
    ).agg(*[F.count_if(c).alias(name) for name, c in flags.items()])
    row = per_point.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags],
        *[
            F.count_if(F.col("point").isNotNull() & (F.col("named") >= k)).alias(f"ge_{k}")
            for k in sizes
        ],
    )
    n, far = F.col("n"), F.col("beyond")
    distance_verdict = (
        F.when(far == 0, "coherent")
        .when(pct(far, n) <= isolated_pct, "isolated_review")
        .otherwise("systematic_review")
    )
    collapse_verdict = F.when(F.col(f"ge_{max(sizes)}") > 0, "collapse").otherwise("no_collapse")
    return metrics_long(
        row,
        [
            count_metric("coverage", "facilities", n),
            count_metric("coverage", "with_coordinates", F.col("located"), n),
            count_metric("coverage", LEVEL_POSTAL, F.col("lvl_cep"), n),
            count_metric("coverage", LEVEL_MUNICIPALITY, F.col("lvl_mun"), n),
            count_metric("coverage", LEVEL_STATE, F.col("lvl_uf"), n),
            *[count_metric("distance", f"gt_{km}km", F.col(f"gt_{km}"), n) for km in thresholds_km],
            *[count_metric("repeated", f"ge_{k}", F.col(f"ge_{k}")) for k in sizes],
            count_metric("downgrade", "candidates", F.col("candidates"), n),
            verdict_metric("verdict", "distance", distance_verdict),
            verdict_metric("verdict", "repeated", collapse_verdict),
        ],
    )
