"""The territory lookup: one row per municipality, with names, codes and a centroid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolink.functions.keys import is_municipality7, prefix, without_last
from geolink.operators.centroid import polygon_centroids
from geolink.operators.joins import translate
from geolink.operators.projection import keep_existing, require_columns

# State codes with abbreviation and name.
STATES = {
    "11": ("RO", "Rondônia"),
    "12": ("AC", "Acre"),
    "13": ("AM", "Amazonas"),
    "14": ("RR", "Roraima"),
    "15": ("PA", "Pará"),
    "16": ("AP", "Amapá"),
    "17": ("TO", "Tocantins"),
    "21": ("MA", "Maranhão"),
    "22": ("PI", "Piauí"),
    "23": ("CE", "Ceará"),
    "24": ("RN", "Rio Grande do Norte"),
    "25": ("PB", "Paraíba"),
    "26": ("PE", "Pernambuco"),
    "27": ("AL", "Alagoas"),
    "28": ("SE", "Sergipe"),
    "29": ("BA", "Bahia"),
    "31": ("MG", "Minas Gerais"),
    "32": ("ES", "Espírito Santo"),
    "33": ("RJ", "Rio de Janeiro"),
    "35": ("SP", "São Paulo"),
    "41": ("PR", "Paraná"),
    "42": ("SC", "Santa Catarina"),
    "43": ("RS", "Rio Grande do Sul"),
    "50": ("MS", "Mato Grosso do Sul"),
    "51": ("MT", "Mato Grosso"),
    "52": ("GO", "Goiás"),
    "53": ("DF", "Distrito Federal"),
}

# Output columns, in output order.
TERRITORY_COLUMNS = [
    "municipio_codigo_7",
    "municipio_codigo_6",
    "municipio_nome",
    "uf_codigo",
    "uf_sigla",
    "uf_nome",
    "centroide_lon",
    "centroide_lat",
    "area_km2",
]

# Mesh attributes, whatever their case in the file.
MESH_NAMES = {
    "CD_MUN": "municipio_codigo_7",
    "NM_MUN": "municipio_nome",
    "SIGLA_UF": "uf_sigla_malha",
    "AREA_KM2": "area_km2",
}


def read_mesh(mesh: DataFrame) -> DataFrame:
    """Mesh attributes under canonical names, for seven-digit codes only; the area is optional."""
    upper = {c.upper(): c for c in mesh.columns}
    require_columns(mesh.toDF(*[c.upper() for c in mesh.columns]), list(MESH_NAMES)[:3])
    present = {m: name for m, name in MESH_NAMES.items() if m in upper}
    out = mesh.select(*[F.col(upper[m]).alias(name) for m, name in present.items()])
    return out.withColumn(
        "municipio_codigo_7", F.col("municipio_codigo_7").cast("string")
    ).where(is_municipality7("municipio_codigo_7"))


def degree_centroids(vertices: DataFrame, poly: str) -> DataFrame:
    """``centroide_lon, centroide_lat`` of polygons whose vertices are longitudes and latitudes.

    The centroid is taken in the cylindrical equal-area projection, in which longitudes stay and
    latitudes become their sines, and brought back. A polygon that is wider than half the globe is taken
    to lie across the 180th meridian. Vertices that are no degrees are an error.
    """
    wide = vertices.groupBy(poly).agg((F.max("x") - F.min("x") > 180).alias("_across")).where("_across")
    vertices = vertices.join(wide, poly, "left")
    in_range = F.col("x").between(-180, 180) & F.col("y").between(-90, 90)
    message = F.lit("polygon vertices must be longitudes and latitudes in degrees")
    flat = F.degrees(F.sin(F.radians("y")))
    checked = F.when(in_range | F.col("x").isNull() | F.col("y").isNull(), flat)
    projected = vertices.withColumns(
        {
            "y": checked.otherwise(F.raise_error(message).cast("double")),
            "x": F.when(F.col("_across") & (F.col("x") < 0), F.col("x") + 360).otherwise(F.col("x")),
        }
    ).drop("_across")
    return polygon_centroids(projected, poly=poly).select(
        poly,
        F.when(F.col("x") > 180, F.col("x") - 360).otherwise(F.col("x")).alias("centroide_lon"),
        F.degrees(F.asin(F.radians("y"))).alias("centroide_lat"),
    )


def territory_lookup(mesh: DataFrame, official: DataFrame, vertices: DataFrame) -> DataFrame:
    """Territory lookup of the municipalities that the official list has.

    ``vertices`` are the mesh polygons, x and y in degrees, keyed by the seven-digit code. All
    three inputs meet on that code, so each is shuffled at most once.
    """
    code = "municipio_codigo_7"
    centroids = degree_centroids(vertices.withColumnRenamed("poly", code), code)
    state = prefix(code, 2)
    out = (
        read_mesh(mesh)
        .join(official, code, "inner")
        .join(centroids, code, "left")
        .withColumns(
            {
                "municipio_nome": F.coalesce("municipio_nome_api", "municipio_nome"),
                "municipio_codigo_6": without_last(code),
                "uf_codigo": state,
                "uf_sigla": F.coalesce(
                    "uf_sigla_malha", translate(state, {k: v[0] for k, v in STATES.items()})
                ),
                "uf_nome": translate(state, {k: v[1] for k, v in STATES.items()}),
            }
        )
    )
    return keep_existing(out, TERRITORY_COLUMNS)


def state_centroids(territory: DataFrame) -> DataFrame:
    """Unweighted mean of the municipal centroids per state; rows without a state are left out."""
    state = ["uf_codigo", "uf_sigla", "uf_nome"]
    return (
        territory.dropna(subset=state)
        .groupBy(*state)
        .agg(F.avg("centroide_lon").alias("uf_lon"), F.avg("centroide_lat").alias("uf_lat"))
    )


def count_by_state(territory: DataFrame) -> DataFrame:
    return territory.groupBy("uf_sigla").agg(F.count("*").alias("n"))
