"""Stage jobs: each reads stored tables and writes one stored table with its summaries.

The stages hand over through Parquet only, so a stage can be run again alone. Summaries are small
metrics tables next to the output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from geolink.operators import bucketed
from geolink.operators.dedupe import require_unique
from geolink.operators.ranking import order_columns
from geolink.operators.stacking import stack_aligned
from geolink.plans import cache as cache_plans
from geolink.plans import (
    conservative,
    coverage,
    enrich,
    facility,
    inspection,
    locate,
    plausibility,
    territory,
)
from geolink.plans.cases import write_cases
from geolink.plans.dictionary import audit_table_schema, dictionary_from_cells, load_summary
from geolink.sources import dictionary as dictionary_source
from geolink.sources import footers, sinks, tables
from geolink.sources.files import find_inputs, list_files
from geolink.sources.payload import official_municipalities, split_payloads

# Fixed value: start of the names of yearly case files.
CASE_PREFIX = "MENIBR"


def stack_cases(
    spark: SparkSession, folder: str, out: str, prefix: str = CASE_PREFIX, suffix: str = ".parquet"
) -> int:
    """Consolidate the yearly case files of a folder and return the row count.

    The files must agree in schema, which tasks read from their footers; all are then one scan. A
    folder whose files have no rows is an error.
    """
    paths = find_inputs(spark, folder, prefix, suffix)
    footers.require_same_columns(footers.footers(footers.list_parts(spark, *paths, pattern="*.parquet")))
    cases = spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)
    return write_cases([tables.require_rows(cases, f"{prefix}* in {folder}")], out)


def load_report(spark: SparkSession, cases: str, dictionary: str, out: str) -> None:
    """Summarise the case table next to its dictionary."""
    document = dictionary_source.read_document(spark, dictionary)
    described, external = dictionary_source.variable_counts(document)
    sinks.write_metrics(load_summary(spark.read.parquet(cases), described, external), out)


def extract_dictionary(spark: SparkSession, cells: str, out: str) -> None:
    """Write the variables found in the table rows of documents as JSON."""
    sinks.write_json(dictionary_from_cells(spark.read.parquet(cells)), out)


def scan_schemas(
    spark: SparkSession, folder: str, groups: Sequence[str], out: str, suffix: str = ".parquet"
) -> None:
    """Scan the latest file of each group for address columns."""
    sinks.write_metrics(inspection.scan_folder(spark, folder, groups, suffix), out)


def inspect_territory(spark: SparkSession, territory_path: str, out: str) -> None:
    """Size of the territory lookup, its rows per state and its first rows."""
    facts = inspection.territory_facts(spark.read.parquet(territory_path))
    for name, table in zip(("total", "per_state", "first_rows"), facts, strict=True):
        sinks.write_metrics(table, f"{out}/{name}")


def audit_schema(spark: SparkSession, cases: str, dictionary: str, out: str) -> None:
    """Compare the case columns with the dictionary."""
    document = dictionary_source.read_document(spark, dictionary)
    counts, one_sided = audit_table_schema(spark.read.parquet(cases), document)
    sinks.write_metrics(counts, f"{out}/counts")
    sinks.write_metrics(one_sided, f"{out}/one_sided")


def build_territory(
    spark: SparkSession, mesh: str, payload: str, vertices: str, out: str, quarantine: str | None = None
) -> None:
    """Build the territory lookup from mesh attributes, the official list and mesh polygons.

    A bad official list is an error, unless ``quarantine`` names a table that takes bad payloads.
    """
    tables.require_paths(spark, mesh, payload, vertices)
    payloads = spark.read.text(payload, wholetext=True).withColumnRenamed("value", "payload")
    if quarantine is None:
        official = official_municipalities(payloads)
    else:
        official, bad = split_payloads(payloads)
        sinks.write_table(bad, quarantine)
        tables.require_rows(official, payload)
    lookup = territory.territory_lookup(
        tables.require_rows(spark.read.parquet(mesh), mesh), official, spark.read.parquet(vertices)
    )
    sinks.write_table(lookup, out, sort_by=["uf_sigla", "municipio_nome", "municipio_codigo_7"])


def audit_coverage(spark: SparkSession, cases: str, territory_path: str, out: str) -> None:
    """Audit territorial keys of the cases against the territory lookup."""
    case_table, lookup = spark.read.parquet(cases), spark.read.parquet(territory_path)
    sinks.write_metrics(coverage.key_coverage(case_table, lookup), f"{out}/coverage")
    sinks.write_metrics(coverage.unmatched_keys(case_table, lookup), f"{out}/unmatched")
    sinks.write_metrics(coverage.state_coherence(case_table), f"{out}/state_coherence")


def build_facilities(
    spark: SparkSession, registry_paths: Sequence[str], cases: str, out: str, period: str
) -> None:
    """Build the facility lookup from registry files, read in name order."""
    registry = tables.read_table_in_order(spark, *registry_paths)
    lookup = facility.facility_lookup(registry, spark.read.parquet(cases), period=period)
    sinks.write_table(lookup, out, sort_by=["cnes_codigo"])


def build_facilities_of_period(
    spark: SparkSession,
    folder: str,
    year: int,
    month: int,
    cases: str,
    out: str,
    prefix: str = "ST",
    suffix: str = ".parquet",
) -> None:
    """Build the facility lookup from the registry files of one period, which also names it."""
    paths = find_inputs(spark, folder, prefix, suffix, year, month)
    build_facilities(spark, paths, cases, out, f"{year:04d}-{month:02d}")


def diagnose_facilities(
    spark: SparkSession, registry_paths: Sequence[str], cases: str, out: str
) -> None:
    """Diagnose the registry for the facilities that the cases name."""
    registry = tables.read_table_in_order(spark, *registry_paths)
    case_table = spark.read.parquet(cases)
    sinks.write_table(facility.facility_diagnosis(registry, case_table), f"{out}/facilities")
    diagnosis = spark.read.parquet(f"{out}/facilities")
    summary = stack_aligned(
        [
            facility.registry_coverage_metrics(registry, case_table),
            facility.diagnosis_summary(diagnosis),
        ]
    )
    sinks.write_metrics(summary, f"{out}/summary")
    if "TP_UNID" in diagnosis.columns:
        sinks.write_metrics(facility.most_frequent(diagnosis, "TP_UNID"), f"{out}/types")


def postal_work_list(
    spark: SparkSession, facilities: str, cache_csv: str, out: str, cap: int | None = None
) -> None:
    """Write the postal codes that still need a location."""
    cached = cache_plans.load_cache(spark, cache_csv)
    fresh = cache_plans.new_postal_codes(spark.read.parquet(facilities), cached, cap)
    fresh.write.mode("overwrite").parquet(out)


def take_in_results(
    spark: SparkSession, incoming: str, results: str, checkpoint: str, files_per_batch: int = 1000
) -> None:
    """Save the result files that have come in since the last run; see ``cache.take_in_results``.

    The first files give the schema; with none there is nothing to do.
    """
    if tables.path_exists(spark, incoming) and not list_files(spark, incoming, "*.parquet").isEmpty():
        schema = spark.read.parquet(incoming).schema
        cache_plans.take_in_results(spark, incoming, schema, results, checkpoint, files_per_batch)


def apply_results(spark: SparkSession, cache_csv: str, results: str, out: str) -> None:
    """Write the cache with the saved results of its work-list: a new CSV, the next cache.

    Per postal code the last row wins, and results come after the cache. The old cache is only
    read, so that a failed run loses nothing.
    """
    if out.rstrip("/") == cache_csv.rstrip("/"):
        raise ValueError("the new cache needs a path of its own")
    found = cache_plans.read_results(spark, results).drop("batch")
    updated = cache_plans.upsert_cache(cache_plans.load_cache(spark, cache_csv), found, order=[])
    sinks.write_csv(cache_plans.as_cache(updated), out)


def locate_facilities(
    spark: SparkSession, facilities: str, cache_csv: str, territory_path: str, out: str
) -> None:
    """Locate facilities and summarise the levels."""
    tables.require_paths(spark, facilities, territory_path)
    located = locate.locate_facilities(
        spark.read.parquet(facilities),
        cache_plans.load_cache(spark, cache_csv),
        spark.read.parquet(territory_path),
        cache_order=["cep_limpo"],
    )
    row = sinks.write_observed(located, out, locate.location_counts(), ["cnes_codigo"])
    sinks.write_metrics(locate.location_metrics(row), f"{out}_summary")
    sinks.write_csv(spark.read.parquet(out), f"{out}_sample", order_columns(ascending=["cnes_codigo"]), n=500)


def audit_locations(spark: SparkSession, located: str, territory_path: str, out: str) -> None:
    """Audit the plausibility of located facilities."""
    audited = plausibility.audit_plausibility(
        spark.read.parquet(located), spark.read.parquet(territory_path)
    )
    sinks.write_table(audited, f"{out}/audited")
    written = spark.read.parquet(f"{out}/audited")
    sinks.write_metrics(plausibility.plausibility_summary(written), f"{out}/summary")
    sinks.write_csv(plausibility.plausibility_sample(written), f"{out}/sample")
    sinks.write_csv(plausibility.top_coordinates(written), f"{out}/top_coordinates")
    sinks.write_csv(plausibility.top_distances(written), f"{out}/top_distances")


def rebuild_locations(
    spark: SparkSession, located: str, territory_path: str, out: str, keep_km: float = 25.0
) -> None:
    """Rebuild locations conservatively and summarise the rules."""
    tables.require_paths(spark, located, territory_path)
    rebuilt = conservative.conservative_locations(
        spark.read.parquet(located), spark.read.parquet(territory_path), keep_km
    )
    row = sinks.write_observed(rebuilt, out, conservative.conservative_counts(), ["cnes_codigo"])
    sinks.write_metrics(conservative.conservative_metrics(row), f"{out}_summary")
    sinks.write_csv(conservative.conservative_sample(spark.read.parquet(out)), f"{out}_sample")


def enrich_cases(
    spark: SparkSession,
    cases: str,
    territory_path: str,
    facilities: str,
    out: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Write the enriched case table, then summarise what was written."""
    tables.require_paths(spark, cases, territory_path, facilities)
    enriched = enrich.enrich_cases(
        spark.read.parquet(cases), spark.read.parquet(territory_path), spark.read.parquet(facilities)
    )
    sinks.write_enriched(enriched, out, partition_by)
    sinks.write_metrics(enrich.enriched_summary(spark.read.parquet(out)), f"{out}_summary")


def bucket_lookups(
    spark: SparkSession, territory_path: str, facilities: str, out: str, buckets: int | None = None
) -> None:
    """Write both lookups in buckets of their keys, for ``enrich_cases_from_buckets``; a repeated key is an error."""
    tables.require_paths(spark, territory_path, facilities)
    for path, key, name in (
        (territory_path, "municipio_codigo_6", "territory"),
        (facilities, "cnes_codigo", "facilities"),
    ):
        bucketed.write_bucketed(spark.read.parquet(path), f"{out}/{name}", key, buckets)
        written = bucketed.read_bucketed(spark, f"{out}/{name}")
        require_unique(written.where(written[key].isNotNull()), [key], name)


def enrich_cases_from_buckets(
    spark: SparkSession, cases: str, lookups: str, out: str, partition_by: Sequence[str] = ()
) -> None:
    """Write the enriched case table from lookups that ``bucket_lookups`` wrote; neither is shuffled."""
    tables.require_paths(spark, cases)
    territory, facilities = (
        bucketed.read_bucketed(spark, f"{lookups}/{name}") for name in ("territory", "facilities")
    )
    enriched = enrich.enrich_cases_bucketed(spark.read.parquet(cases), territory, facilities)
    sinks.write_enriched(enriched, out, partition_by)
    sinks.write_metrics(enrich.enriched_summary(spark.read.parquet(out)), f"{out}_summary")


def build_minimal_lookup(
    spark: SparkSession, registry_paths: Sequence[str], cases: str, out: str
) -> None:
    """Build and audit the minimal facility lookup."""
    registry = tables.read_table_in_order(spark, *registry_paths)
    sinks.write_table(facility.minimal_lookup(registry), out)
    lookup, case_table = spark.read.parquet(out), spark.read.parquet(cases)
    sinks.write_metrics(facility.minimal_lookup_completeness(lookup), f"{out}_completeness")
    sinks.write_metrics(facility.minimal_lookup_coverage(case_table, lookup), f"{out}_coverage")
    sinks.write_metrics(facility.minimal_lookup_unmatched(case_table, lookup), f"{out}_unmatched")
