"""All stage jobs in sequence over stored tables, from raw files to the enriched table."""

import pytest
from pyspark.sql import functions as F

from geolink import jobs, standins
from geolink.plans import inspection
from geolink.sources.files import find_inputs

FOLDER = "/root/testdata/sf0.001"


def single_file(df, path):
    """Write a table as one file with a name of its own."""
    df.toPandas().to_parquet(path)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    cases = standins.cases(spark, FOLDER)
    (root / "raw").mkdir()
    single_file(cases.where("case_id % 2 = 0"), root / "raw" / "MENIBR07.parquet")
    single_file(cases.where("case_id % 2 = 1"), root / "raw" / "MENIBR08.parquet")
    single_file(cases.limit(3), root / "raw" / "OTHER08.parquet")
    registry = standins.registry(spark, FOLDER).orderBy("ord").drop("ord")
    single_file(registry.where("TP_UNID < '10'"), root / "raw" / "STAA2601.parquet")
    single_file(registry.where("TP_UNID >= '10'"), root / "raw" / "STBB2601.parquet")
    standins.territory(spark, FOLDER).write.parquet(str(root / "territory"))
    cached = standins.cache(spark, FOLDER).orderBy("seq").drop("seq")
    cached.toPandas().to_csv(root / "cache.csv", index=False)
    return root


def metrics(spark, path):
    schema = "section string, metric string, n long, pct double, verdict string"
    rows = spark.read.schema(schema).option("header", True).csv(str(path)).collect()
    return {(r.section, r.metric): r.n for r in rows}


def test_jobs(spark, root):
    n = spark.read.parquet(f"{FOLDER}/orders.parquet").count()
    cases, units = f"{root}/cases", f"{root}/facilities"
    territory, cache = f"{root}/territory", f"{root}/cache.csv"
    assert jobs.stack_cases(spark, f"{root}/raw", cases) == n

    jobs.audit_coverage(spark, cases, territory, f"{root}/coverage")
    registry = find_inputs(spark, f"{root}/raw", "ST")
    assert [p.rsplit("/", 1)[-1] for p in registry] == ["STAA2601.parquet", "STBB2601.parquet"]
    jobs.build_facilities(spark, registry, cases, units, "2026-01")
    jobs.diagnose_facilities(spark, registry, cases, f"{root}/diagnosis")
    written = spark.read.parquet(units)
    # Reading order gives the same first values as the ordinal of the stand-in.
    from geolink.plans.facility import facility_lookup

    direct = facility_lookup(standins.registry(spark, FOLDER), standins.cases(spark, FOLDER))
    assert written.exceptAll(direct).count() == direct.exceptAll(written).count() == 0
    assert metrics(spark, root / "diagnosis" / "summary")["postal_code", "facilities"] == written.count()

    jobs.postal_work_list(spark, units, cache, f"{root}/work_list")
    todo = [r[0] for r in spark.read.parquet(f"{root}/work_list").collect()]
    assert todo == sorted(set(todo)) and todo

    jobs.locate_facilities(spark, units, cache, territory, f"{root}/located")
    levels = metrics(spark, root / "located_summary")
    assert levels["level", "facilities"] == written.count()
    assert sum(v for (_, m), v in levels.items() if m != "facilities") == written.count()

    jobs.audit_locations(spark, f"{root}/located", territory, f"{root}/audit")
    jobs.rebuild_locations(spark, f"{root}/located", territory, f"{root}/rebuilt")
    audit, rules = metrics(spark, root / "audit" / "summary"), metrics(spark, root / "rebuilt_summary")
    assert rules["level", "cep"] == rules["rule", "manter_cep"]
    lost = rules["level", "municipio"] + rules["level", "uf"] + rules["level", "sem_localizacao"]
    assert rules["level", "cep"] + lost == written.count()
    assert audit["distance", "gt_25km"] <= lost

    jobs.enrich_cases(spark, cases, territory, f"{root}/rebuilt", f"{root}/enriched", ["SG_UF_NOT"])
    enriched = spark.read.parquet(f"{root}/enriched")
    assert enriched.count() == n and len(enriched.columns) == 54
    summary = metrics(spark, root / "enriched_summary")
    assert summary["enriched", "rows"] == n
    assert summary["enriched", "notification_located"] == n
    pruned = enriched.where("SG_UF_NOT = '11'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SG_UF_NOT" in pruned

    jobs.bucket_lookups(spark, territory, f"{root}/rebuilt", f"{root}/lookups", 4)
    jobs.enrich_cases_from_buckets(spark, cases, f"{root}/lookups", f"{root}/enriched2")
    again = spark.read.parquet(f"{root}/enriched2").select(enriched.columns)
    assert again.exceptAll(enriched).count() == enriched.exceptAll(again).count() == 0
    assert metrics(spark, root / "enriched2_summary") == summary
    spark.read.parquet(territory).unionAll(spark.read.parquet(territory)).write.parquet(f"{root}/twice")
    with pytest.raises(ValueError, match="repeated keys"):
        jobs.bucket_lookups(spark, f"{root}/twice", f"{root}/rebuilt", f"{root}/lookups2", 4)


def test_minimal_lookup_job(spark, root):
    raw = f"{root}/minimal_raw"
    standins.coordinate_registry(spark, FOLDER).drop("ord").coalesce(1).write.parquet(raw)
    standins.cases(spark, FOLDER).write.parquet(f"{root}/cases_minimal")
    jobs.build_minimal_lookup(spark, [raw], f"{root}/cases_minimal", f"{root}/minimal")
    assert spark.read.parquet(f"{root}/minimal").count() == 9


def test_territory_job(spark, root):
    standins.mesh(spark, FOLDER).write.parquet(f"{root}/mesh")
    standins.mesh_vertices(spark, FOLDER).write.parquet(f"{root}/vertices")
    payloads = [r.payload for r in standins.official_payloads(spark, FOLDER).collect()]
    merged = "[" + ",".join(p[1:-1] for p in payloads) + "]"
    (root / "official.json").write_text(merged)
    jobs.build_territory(
        spark, f"{root}/mesh", f"{root}/official.json", f"{root}/vertices", f"{root}/lookup"
    )
    found = spark.read.parquet(f"{root}/lookup")
    assert found.count() == 124 and found.where("centroide_lat is null").count() == 0
    assert found.groupBy("municipio_codigo_7").count().where("count > 1").count() == 0


def test_schema_job(spark, root):
    spark.range(1).select(F.lit("1").alias("TP_NOT"), F.lit("x").alias("EXTRA")).write.parquet(f"{root}/small")
    (root / "dictionary.json").write_text('{"variables": {"TP_NOT": {}, "DT_NOTIFIC": {}}}')
    jobs.audit_schema(spark, f"{root}/small", f"{root}/dictionary.json", f"{root}/schema")
    assert metrics(spark, root / "schema" / "counts")["schema", "in_both"] == 1


def test_inspect_latest(spark, root):
    facts, first = inspection.inspect_latest(spark, f"{root}/raw", ["case_id"], "MENIBR")
    assert facts.first().file == "MENIBR08.parquet" and first.count() == 3
    with pytest.raises(FileNotFoundError):
        inspection.inspect_latest(spark, f"{root}/raw", ["case_id"], "NONE")


def test_cache_cycle(spark, tmp_path):
    """Work-list, results in batches, and a new cache in which they are."""
    from geolink.plans import cache as cache_plans

    units = spark.createDataFrame([("10000000",), ("20000000",), ("30000000",)], "cep_limpo string")
    units.write.parquet(f"{tmp_path}/units")
    old = spark.createDataFrame([("10000000", "1.5", "2.5", "True")], "cep_limpo string, latitude string, longitude string, geocode_success string")
    old.toPandas().to_csv(f"{tmp_path}/cache.csv", index=False)
    jobs.postal_work_list(spark, f"{tmp_path}/units", f"{tmp_path}/cache.csv", f"{tmp_path}/work")
    wanted = [r.cep_limpo for r in spark.read.parquet(f"{tmp_path}/work").collect()]
    assert wanted == ["20000000", "30000000"]
    schema = "cep_limpo string, latitude double, longitude double, geocode_success boolean"
    first = spark.createDataFrame([("20000000", 3.0, 4.0, True), ("30000000", None, None, False)], schema)
    cache_plans.append_results(first, f"{tmp_path}/results", 1)
    again = spark.createDataFrame([("30000000", 5.0, 6.0, True), ("10000000", 7.0, 8.0, True)], schema)
    cache_plans.append_results(again, f"{tmp_path}/results", 2)
    jobs.apply_results(spark, f"{tmp_path}/cache.csv", f"{tmp_path}/results", f"{tmp_path}/next")
    rows = cache_plans.load_cache(spark, f"{tmp_path}/next").collect()
    assert sorted((r.cep_limpo, float(r.latitude), r.geocode_success) for r in rows) == [
        ("10000000", 7.0, "True"),
        ("20000000", 3.0, "True"),
        ("30000000", 5.0, "True"),
    ]
    jobs.postal_work_list(spark, f"{tmp_path}/units", f"{tmp_path}/next", f"{tmp_path}/work2")
    assert spark.read.parquet(f"{tmp_path}/work2").count() == 0
    with pytest.raises(ValueError, match="path of its own"):
        jobs.apply_results(spark, f"{tmp_path}/next", f"{tmp_path}/results", f"{tmp_path}/next/")


def test_registry_of_a_period_with_columns_of_the_second_file_only(spark, root, tmp_path):
    import pandas as pd

    folder = tmp_path / "registry"
    folder.mkdir()
    pd.DataFrame({"CNES": ["0000001"], "TP_UNID": ["05"]}).to_parquet(folder / "STAA2601.parquet")
    pd.DataFrame({"CNES": ["0000001"], "COD_CEP": ["12345678"]}).to_parquet(folder / "STBB2601.parquet")
    pd.DataFrame({"CNES": ["0000001"], "COD_CEP": ["99999999"]}).to_parquet(folder / "STBB2512.parquet")
    spark.createDataFrame([("0000001",)], "ID_UNIDADE string").write.parquet(f"{tmp_path}/cases")
    jobs.build_facilities_of_period(spark, str(folder), 2026, 1, f"{tmp_path}/cases", f"{tmp_path}/units")
    row = spark.read.parquet(f"{tmp_path}/units").first()
    assert (row.tp_unid, row.cep_limpo, row.cnes_competencia) == ("05", "12345678", "2026-01")
    jobs.scan_schemas(spark, str(folder), ["ST"], f"{tmp_path}/scan")
    scanned = spark.read.option("header", True).csv(f"{tmp_path}/scan").collect()
    assert [(r.arquivo, r.coluna, r.primeiro) for r in scanned] == [("STBB2601.parquet", "COD_CEP", "12345678")]


def test_reports(spark, root, tmp_path):
    (tmp_path / "dictionary.json").write_text('{"variables": {"A": {}, "B": {}}, "external_lookup_variables": ["C"]}')
    standins.cases(spark, FOLDER).limit(5).write.parquet(f"{tmp_path}/cases")
    jobs.load_report(spark, f"{tmp_path}/cases", f"{tmp_path}/dictionary.json", f"{tmp_path}/load")
    found = metrics(spark, tmp_path / "load")
    assert found["load", "described_variables"] == 2 and found["load", "external_variables"] == 1
    jobs.inspect_territory(spark, f"{root}/territory", f"{tmp_path}/territory")
    total = spark.read.option("header", True).csv(f"{tmp_path}/territory/total").first()
    assert int(total.n) == standins.territory(spark, FOLDER).count()
    standins.dictionary_rows(spark, FOLDER).write.parquet(f"{tmp_path}/cells")
    jobs.extract_dictionary(spark, f"{tmp_path}/cells", f"{tmp_path}/variables")
    assert spark.read.json(f"{tmp_path}/variables").count() > 0
