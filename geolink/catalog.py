"""The registered queries: every operator over whole tables derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolink import standins
from geolink.functions import keys
from geolink.functions.ratios import pct
from geolink.operators import bucketed, joins, projection, ranking, stacking, staging
from geolink.operators.centroid import polygon_centroids
from geolink.plans import (
    cache,
    conservative,
    coverage,
    dictionary,
    enrich,
    facility,
    inspection,
    locate,
    plausibility,
    territory,
)
from geolink.sources import dictionary as dictionary_source
from geolink.sources import files, footers, payload, sinks
from geolink.sources.tables import read_table_in_order, read_text_csv, split_text_csv

Query = Callable[[SparkSession, str], DataFrame]


def round6(df: DataFrame, *names: str) -> DataFrame:
    """Round exported distances and means, whose last bits differ between engines."""
    return df.withColumns({c: F.bround(c, 6) for c in names})


# Inputs that several queries share.


def facilities(spark: SparkSession, d: str) -> DataFrame:
    return facility.facility_lookup(standins.registry(spark, d), standins.cases(spark, d))


def located(spark: SparkSession, d: str) -> DataFrame:
    return locate.locate_facilities(
        facilities(spark, d), standins.cache(spark, d), standins.territory(spark, d)
    )


def audited(spark: SparkSession, d: str) -> DataFrame:
    return plausibility.audit_plausibility(located(spark, d), standins.territory(spark, d))


def rebuilt(spark: SparkSession, d: str) -> DataFrame:
    return conservative.conservative_locations(located(spark, d), standins.territory(spark, d))


def enriched(spark: SparkSession, d: str) -> DataFrame:
    """Cases with their links. The facility table is staged, as it is measured and then joined."""
    units = staging.stage_table(rebuilt(spark, d), "facilities")
    return enrich.enrich_cases(standins.cases(spark, d), standins.territory(spark, d), units)


def territory_table(spark: SparkSession, d: str) -> DataFrame:
    return territory.territory_lookup(
        standins.mesh(spark, d),
        payload.official_municipalities(standins.official_payloads(spark, d)),
        standins.mesh_vertices(spark, d),
    )


def minimal(spark: SparkSession, d: str) -> DataFrame:
    return facility.minimal_lookup(standins.coordinate_registry(spark, d))


# Queries.


def q_enriched_cases(spark, d):
    return round6(enriched(spark, d), "unidade_latitude", "unidade_longitude")


def q_enriched_bucketed(spark, d):
    """The enriched cases from lookups in buckets, which are written first."""
    places, units = (staging.stage_path(spark, name) for name in ("territory", "facilities"))
    bucketed.write_bucketed(standins.territory(spark, d), places, "municipio_codigo_6")
    bucketed.write_bucketed(rebuilt(spark, d), units, "cnes_codigo")
    linked = enrich.enrich_cases_bucketed(
        standins.cases(spark, d), bucketed.read_bucketed(spark, places), bucketed.read_bucketed(spark, units)
    )
    return round6(linked, "unidade_latitude", "unidade_longitude")


def q_enriched_validation(spark, d):
    return enrich.enriched_summary(enriched(spark, d))


def q_enriched_sample(spark, d):
    units = staging.stage_table(rebuilt(spark, d), "facilities")
    sample = enrich.first_enriched(
        standins.cases(spark, d), standins.territory(spark, d), units, "case_id"
    )
    return round6(sample, "unidade_latitude", "unidade_longitude")


def q_key_coverage(spark, d):
    return coverage.key_coverage(standins.cases(spark, d), standins.territory(spark, d))


def q_unmatched_keys(spark, d):
    return coverage.unmatched_keys(standins.cases(spark, d), standins.territory(spark, d))


def q_state_coherence(spark, d):
    return coverage.state_coherence(standins.cases(spark, d))


def q_facility_lookup(spark, d):
    return facilities(spark, d)


def q_facility_quality(spark, d):
    registry, cases = standins.registry(spark, d), standins.cases(spark, d)
    return facility.registry_coverage_metrics(registry, cases).unionByName(
        facility.diagnosis_summary(facility.facility_diagnosis(registry, cases))
    )


def q_type_top15(spark, d):
    diagnosis = facility.facility_diagnosis(standins.registry(spark, d), standins.cases(spark, d))
    return facility.most_frequent(diagnosis, "TP_UNID")


def q_coverage_ratio(spark, d):
    return facility.registry_coverage(standins.registry(spark, d), standins.cases(spark, d))


def q_location_fallback(spark, d):
    return round6(located(spark, d), "latitude", "longitude")


def q_location_summary(spark, d):
    return locate.location_summary(located(spark, d))


def q_plausibility(spark, d):
    sample = projection.keep_existing(
        audited(spark, d),
        [*plausibility.SAMPLE_COLUMNS, *[f"dist_gt_{km}km" for km in (25, 50, 100, 250)]],
    )
    return round6(sample, "latitude", "longitude", plausibility.DISTANCE)


def q_plausibility_summary(spark, d):
    return plausibility.plausibility_summary(audited(spark, d))


def q_top_distances(spark, d):
    # The rounding comes first, so that the order of near ties does not hang on last bits.
    rows = round6(audited(spark, d), "latitude", "longitude", plausibility.DISTANCE)
    return plausibility.top_distances(rows)


def q_coordinate_collapse(spark, d):
    return plausibility.top_coordinates(audited(spark, d))


def q_collapse_counts(spark, d):
    return plausibility.collapse_counts(audited(spark, d))


def q_conservative(spark, d):
    return round6(
        rebuilt(spark, d),
        "latitude",
        "longitude",
        "latitude_cep_original",
        "longitude_cep_original",
        plausibility.DISTANCE,
    )


def q_conservative_summary(spark, d):
    return conservative.conservative_summary(rebuilt(spark, d))


def q_cache_worklist(spark, d):
    return cache.new_postal_codes(facilities(spark, d), standins.cache(spark, d))


def q_cache_upsert(spark, d):
    return cache.upsert_cache(standins.cache(spark, d), standins.new_results(spark, d))


def q_territory_lookup(spark, d):
    return round6(territory_table(spark, d), "centroide_lon", "centroide_lat")


def q_polygon_centroid(spark, d):
    return round6(polygon_centroids(standins.mesh_vertices(spark, d)), "x", "y")


def q_state_centroids(spark, d):
    return round6(territory.state_centroids(territory_table(spark, d)), "uf_lon", "uf_lat")


def q_lookup_by_state(spark, d):
    return territory.count_by_state(territory_table(spark, d))


def q_lookup_first_rows(spark, d):
    rows = inspection.territory_facts(territory_table(spark, d))[2]
    return round6(rows, "centroide_lon", "centroide_lat")


def q_minimal_lookup(spark, d):
    return minimal(spark, d)


def q_minimal_completeness(spark, d):
    return facility.minimal_lookup_completeness(minimal(spark, d))


def q_minimal_audit(spark, d):
    return facility.minimal_lookup_coverage(standins.cases(spark, d), minimal(spark, d))


def q_minimal_unmatched(spark, d):
    return facility.minimal_lookup_unmatched(standins.cases(spark, d), minimal(spark, d))


def observed_columns(spark, d):
    return standins.column_inventory(spark, d).select(F.col("coluna").alias("name"))


def q_schema_audit(spark, d):
    return dictionary.audit_names(observed_columns(spark, d), standins.declared_columns(spark, d))


def q_schema_differences(spark, d):
    return dictionary.one_sided_names(
        observed_columns(spark, d), standins.declared_columns(spark, d)
    )


def q_dictionary_cells(spark, d):
    """One row per code; a variable without codes keeps one row."""
    entries = dictionary.dictionary_from_cells(standins.dictionary_rows(spark, d))
    return entries.select(
        "name", "label", "pagina", F.explode_outer("fatores").alias("codigo", "fator")
    )


def q_document_names(spark, d):
    """Name tokens of whole documents, with their frequency."""
    words = standins.table(spark, d, "documents").select(
        F.explode(F.split("text", "[ \n]")).alias("word")
    )
    return (
        words.where(keys.is_variable_name("word"))
        .groupBy(keys.stripped("word").alias("name"))
        .agg(F.count("*").alias("n"))
    )


def q_file_select(spark, d):
    return files.select_files(standins.file_names(spark, d), "ST", 1998, 3)


def q_file_latest(spark, d):
    return files.latest_files(standins.file_names(spark, d), "grupo")


def q_json_payload(spark, d):
    return payload.official_municipalities(standins.event_payloads(spark, d))


def _orders_by_status(spark, d):
    orders = standins.table(spark, d, "orders")
    known = ["F", "O"]
    return [
        *[orders.where(F.col("o_orderstatus") == s) for s in known],
        orders.where(~F.col("o_orderstatus").isin(known) | F.col("o_orderstatus").isNull()),
    ]


def _dated_orders(spark, d):
    day = F.col("o_orderdate").cast("date")
    return [part.withColumn("o_orderdate", day) for part in _orders_by_status(spark, d)]


def q_stack(spark, d):
    day = F.col("o_orderdate").cast("date")
    return stacking.stack_strict(_orders_by_status(spark, d)).withColumn("o_orderdate", day)


def q_stack_aligned(spark, d):
    filled, opened, rest = _dated_orders(spark, d)
    return stacking.stack_aligned(
        [filled.drop("o_orderpriority"), opened.drop("o_custkey"), rest]
    )


def q_aligned_files(spark, d):
    """Parts with different columns, written apart and read as one table in order."""
    filled, opened, rest = _dated_orders(spark, d)
    paths = []
    for part in (filled.drop("o_orderpriority"), opened.drop("o_custkey"), rest):
        paths.append(staging.stage_path(spark, "part"))
        sinks.write_table(part, paths[-1])
    return read_table_in_order(spark, *paths).drop("ord")


def q_results_log(spark, d):
    """Batches of results, appended one by one and read back: the last row per key."""
    out = staging.stage_path(spark, "results")
    results = standins.new_results(spark, d)
    cache.append_results(results, out, 1)
    again = results.where("seq % 5 = 0").withColumn("latitude", F.col("latitude") + 1)
    cache.append_results(again, out, 2)
    return cache.read_results(spark, out, ["seq"])


def q_schema_scan(spark, d):
    return inspection.scan_inventory(standins.column_inventory(spark, d))


GROUPS = ["ST", "EP", "DC", "PF"]


def named_folder(spark, d):
    """A folder of many tables, each named by its group and period."""
    out = staging.stage_path(spark, "named")
    standins.named_tables(spark, d, out)
    return out


def q_file_inspection(spark, d):
    """Rows and columns of the latest file of each group in a folder, from the footers."""
    facts = inspection.inspect_groups(spark, named_folder(spark, d), GROUPS)
    return facts.withColumnRenamed("group", "grupo")


def q_folder_scan(spark, d):
    """Address columns of the latest file of each group in a folder, with their first values."""
    return inspection.scan_folder(spark, named_folder(spark, d), GROUPS)


def q_folder_footers(spark, d):
    """Columns, types and rows of all files of a folder, from the footers."""
    found = footers.footers(footers.list_parts(spark, named_folder(spark, d), pattern="*.parquet"))
    return footers.table_columns(found).drop("path", "first")


def q_quarantined_payloads(spark, d):
    """Rows of the good payloads, and the bad payloads by fault, counted."""
    good, bad = payload.split_payloads(standins.broken_payloads(spark, d))
    return payload.fault_counts(bad).unionByName(
        good.agg(F.lit("none").alias("fault"), F.count("*").alias("n"))
    )


def q_quarantined_lines(spark, d):
    """A CSV with lines that do not fit its header: the good rows, and the others whole, with their fault."""
    out = staging.stage_path(spark, "lines")
    good = ["cep_limpo", "latitude", "geocode_success"]
    # Text that begins with the header in each part file, as a CSV does.
    lines = standins.broken_lines(spark, d).withColumn("place", F.lit(1))
    header = lines.limit(1).select(F.lit(",".join(good)).alias("value"), F.lit(0).alias("place"))
    header.unionByName(lines).coalesce(1).sortWithinPartitions("place").select("value").write.text(out)
    rows, bad = split_text_csv(spark, out, good)
    return rows.unionByName(bad, allowMissingColumns=True)


def q_conservative_numbered(spark, d):
    """Rebuilt facilities with their number: by rule ascending, then by distance descending."""
    names = ["cnes_codigo", "regra_aplicada", plausibility.DISTANCE]
    rows = round6(rebuilt(spark, d).select(*names), plausibility.DISTANCE)
    return ranking.numbered(rows, "n", conservative.conservative_order())


def q_plausibility_numbered(spark, d):
    """Audited facilities with their number: candidates and the farthest first."""
    names = ["cnes_codigo", plausibility.CANDIDATE, plausibility.DISTANCE]
    rows = round6(audited(spark, d).select(*names), plausibility.DISTANCE)
    return ranking.numbered(rows, "n", plausibility.plausibility_order())


def q_cache_stream(spark, d):
    """The cache with new results that came in as files and were taken in as a stream."""
    incoming, out, checkpoint = (staging.stage_path(spark, n) for n in ("incoming", "results", "stream"))
    results = standins.new_results(spark, d)
    sinks.write_table(results.repartition(4, "seq"), incoming)
    cache.take_in_results(spark, incoming, results.schema, out, checkpoint, files_per_batch=1)
    return cache.upsert_cache(standins.cache(spark, d), cache.saved_results(spark, out).drop("batch"))


def q_first_rows(spark, d):
    rows = inspection.first_rows(standins.table(spark, d, "orders"), ["o_orderkey"])
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def q_load_summary(spark, d):
    """Cases next to a dictionary that is written from the parts and loaded again."""
    out = staging.stage_path(spark, "dictionary")
    entry = F.struct("name", F.create_map(F.lit("label"), F.col("name")))
    names = standins.declared_columns(spark, d)
    described = F.map_from_entries(F.collect_list(F.when(F.col("name").startswith("QT"), entry)))
    external = F.collect_list(F.when(~F.col("name").startswith("QT"), F.col("name")))
    document = F.struct(
        described.alias("variables"), external.alias("external_lookup_variables")
    )
    names.agg(F.to_json(document).alias("value")).write.text(out)
    counts = dictionary_source.variable_counts(
        dictionary_source.read_document(spark, out, kind="json")
    )
    return dictionary.load_summary(standins.cases(spark, d), *counts)


def q_roundtrip_csv(spark, d):
    """Cases written as CSV and read back as text; a blank text is no null."""
    out = staging.stage_path(spark, "csv")
    cases = standins.cases(spark, d).withColumn("case_id", F.col("case_id").cast("string"))
    sinks.write_csv(cases, out)
    return read_text_csv(spark, out, [*cases.columns, "NOT_THERE"])


def q_roundtrip_parquet(spark, d):
    """Cases written as zstd Parquet and read back."""
    out = staging.stage_path(spark, "parquet")
    sinks.write_table(standins.cases(spark, d), out, compression="zstd")
    return spark.read.parquet(out)


def q_roundtrip_json(spark, d):
    """Dictionary entries with their maps, written as JSON and read back."""
    out = staging.stage_path(spark, "json")
    entries = dictionary.dictionary_from_cells(standins.dictionary_rows(spark, d))
    sinks.write_json(entries, out)
    back = spark.read.schema(entries.schema).json(out)
    return back.select(
        "name", "label", "pagina", F.explode_outer("fatores").alias("codigo", "fator")
    )


def q_metrics_long(spark, d):
    """A summary written as a metrics table and read back."""
    out = staging.stage_path(spark, "metrics")
    metrics = locate.location_summary(located(spark, d))
    sinks.write_metrics(metrics, out)
    return spark.read.schema(metrics.schema).option("header", True).csv(out)


def q_projection_rules(spark, d):
    """Existing columns, defaults, constants, renaming and ordered masks, sorted by key."""
    registry = standins.registry(spark, d).drop("COD_CEP")
    rows = projection.keep_existing(registry, [*facility.REGISTRY_COLUMNS, "ord"])
    rows = projection.with_defaults(rows, {"COD_CEP": ("string", ""), "AREA": ("double", None)})
    rows = projection.with_constants(rows, {"source_system": facility.SOURCE_SYSTEM})
    rows = rows.withColumnsRenamed(facility.ADMINISTRATIVE_NAMES)
    level = keys.ladder(
        keys.LEVEL_NONE,
        (keys.is_state2(keys.prefix("CODUFMUN", 2)), keys.LEVEL_STATE),
        (keys.is_municipality6("CODUFMUN"), keys.LEVEL_MUNICIPALITY),
    )
    ordered = rows.withColumn("level", level).drop("nat_jur")
    return ordered.orderBy(F.col("CNES").asc_nulls_last(), F.col("ord").asc_nulls_last())


def q_label_building(spark, d):
    names = standins.file_names(spark, d).where(keys.has_period("name"))
    return (
        names.select(
            keys.period_label(
                F.lit(1900) + keys.name_year("name").cast("int"), keys.name_month("name").cast("int")
            ).alias("period"),
            keys.zero_fill(F.length("name"), 3).alias("width"),
        )
        .groupBy("period", "width")
        .agg(F.count("*").alias("n"))
    )


def q_geocode_queries(spark, d):
    results = standins.new_results(spark, d)
    return results.select(
        "seq",
        keys.geocode_query("cep_limpo").alias("geocode_query"),
        keys.flag_text("geocode_success").alias("geocode_success"),
    )


def q_key_validity(spark, d):
    """Registry rows by validity of their codes, with percentages."""
    rows = standins.registry(spark, d).select(
        keys.is_postal_code("COD_CEP").alias("cep_valido"),
        keys.is_municipality6("CODUFMUN").alias("municipio_valido"),
        keys.is_filled("COD_CEP").alias("cep_preenchido"),
    )
    totals = rows.groupBy("cep_valido", "municipio_valido").agg(
        F.count("*").alias("n"), F.count_if("cep_preenchido").alias("n_filled")
    )
    return totals.withColumn("pct_filled", pct("n_filled", "n"))


def q_shared_facilities(spark, d):
    """Registry rows whose facility the cases name, and those it does not, per type."""
    registry = standins.registry(spark, d).groupBy("CNES").agg(F.min("TP_UNID").alias("TP_UNID"))
    wanted = facility.case_facilities(standins.cases(spark, d))
    named = joins.matching(registry, wanted, ["CNES"]).withColumn("named", F.lit(True))
    unnamed = joins.missing(registry, wanted, ["CNES"]).withColumn("named", F.lit(False))
    return named.unionByName(unnamed).groupBy("TP_UNID", "named").agg(F.count("*").alias("n"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("q_")}
