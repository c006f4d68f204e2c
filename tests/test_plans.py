"""Composite operators on small tables with the edge cases of each rule."""

import math

import pytest
from pyspark.sql import functions as F

from geolink.operators import bucketed
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

TERRITORY = "municipio_codigo_7 string, municipio_codigo_6 string, municipio_nome string, uf_codigo string, uf_sigla string, uf_nome string, centroide_lon double, centroide_lat double, area_km2 double"
PLACES = [
    ("1100015", "110001", "Alta", "11", "RO", "Rondônia", -62.0, -12.0, 10.0),
    ("1100023", "110002", "Ariquemes", "11", "RO", "Rondônia", -63.0, -10.0, None),
    ("1200013", "120001", "Acrelândia", "12", "AC", "Acre", -67.0, None, 5.0),
    ("1300029", "130002", "Alvarães", "13", None, "Amazonas", -65.0, -3.0, 5.0),
]
FACILITY = "cnes_codigo string, cep_limpo string, municipio_codigo_6 string, uf_codigo string"


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(PLACES, TERRITORY)


def metric(df):
    return {(r.section, r.metric): (r.n, r.pct) for r in df.collect()}


def verdicts(df):
    return {r.metric: r.verdict for r in df.collect() if r.section == "verdict"}


# Coverage.

CASES = "case_id long, ID_MN_RESI string, ID_MUNICIP string, ATE_MUNICI string, SG_UF string, SG_UF_NOT string, ATE_UF_HOS string, ID_UNIDADE string"
CASE_ROWS = [
    (1, "110001", "110001", None, "11", "11", None, " 0000001 "),
    (2, "110001 ", "110002", "  ", "12", "11", "1", "0000001"),
    (3, "110000", None, "1100", "11", None, "9", "0000002\t"),
    (4, None, "110002", None, None, "11", "11", "  "),
    (5, "110002", "110001", None, "", "13", "11", None),
    (6, "110002", "110001", None, "9", "11", "11", "0000009"),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASE_ROWS, CASES)


def test_key_coverage(spark, cases, places):
    found = {r.field: tuple(r)[1:] for r in coverage.key_coverage(cases, places).collect()}
    assert found == {
        "ID_MUNICIP": (5, 2, 2, 0),
        "ID_MN_RESI": (5, 3, 2, 1),
        "ATE_MUNICI": (1, 1, 0, 1),
    }
    empty = coverage.key_coverage(cases.limit(0), places).collect()
    assert sorted(tuple(r) for r in empty) == sorted((f, 0, 0, 0, 0) for f in coverage.MUNICIPALITY_FIELDS)


def test_unmatched_keys(spark, cases, places):
    found = [tuple(r) for r in coverage.unmatched_keys(cases, places).orderBy("field").collect()]
    assert found == [("ATE_MUNICI", "1100"), ("ID_MN_RESI", "110000")]
    many = spark.range(200).select(F.format_string("%06d", "id").alias("ID_MUNICIP"))
    found = coverage.unmatched_keys(many, places, ["ID_MUNICIP"]).orderBy("codigo").collect()
    assert [r.codigo for r in found] == [f"{i:06d}" for i in range(50)]


def test_state_coherence(cases):
    found = {r.municipality_field: tuple(r)[2:] for r in coverage.state_coherence(cases).collect()}
    assert found == {"ID_MUNICIP": (5, 1), "ID_MN_RESI": (4, 2), "ATE_MUNICI": (1, 1)}


# Facilities.

REGISTRY = "CNES string, CODUFMUN string, COD_CEP string, TP_UNID string, ord long"
REGISTRY_ROWS = [
    ("0000001\t", " ", None, "05", 1),
    ("0000001", "110001", "77.693-000", "07", 2),
    ("0000001", "110002", "11111-111", None, 3),
    ("0000002", "11", "00000-000", " ", 4),
    ("0000003", "110001", "77.693-000", "05", 5),
    (None, "110001", "77.693-000", "05", 6),
    ("0000009", "0000009", "77.693-00", "01", 7),
]


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame(REGISTRY_ROWS, REGISTRY)


def test_facility_lookup(registry, cases):
    found = {r.cnes_codigo: r for r in facility.facility_lookup(registry, cases).collect()}
    assert set(found) == {"0000001", "0000002", "0000009"}
    one = found["0000001"]
    assert (one.codufmun, one.cod_cep, one.cep_limpo, one.tp_unid) == (
        "110001", "77.693-000", "77693000", "05",
    )
    assert (one.cep_valido, one.municipio_valido, one.uf_valida) == (True, True, True)
    assert one.spatial_resolution_available == "cep"
    two = found["0000002"]
    assert (two.municipio_codigo_6, two.uf_codigo, two.tp_unid) == ("11", "11", None)
    assert (two.cep_valido, two.municipio_valido, two.uf_valida) == (False, False, True)
    assert two.spatial_resolution_available == "uf"
    nine = found["0000009"]
    assert (nine.municipio_codigo_6, nine.spatial_resolution_available) == ("000000", "sem_localizacao")
    assert "tpgestao" not in facility.facility_lookup(registry, cases).columns
    assert one.cnes_competencia == "2026-01" and one.fallback_rule == "cep->municipio->uf"


def test_facility_lookup_does_not_depend_on_row_order(spark, registry, cases):
    want = sorted(tuple(r) for r in facility.facility_lookup(registry, cases).collect())
    for rows in (REGISTRY_ROWS[::-1], REGISTRY_ROWS[3:] + REGISTRY_ROWS[:3]):
        other = spark.createDataFrame(rows, REGISTRY).repartition(4)
        got = sorted(tuple(r) for r in facility.facility_lookup(other, cases).collect())
        assert str(got) == str(want)


def test_facility_lookup_without_optional_columns(registry, cases):
    bare = registry.select("CNES", "ord")
    found = facility.facility_lookup(bare, cases).collect()
    assert {(r.cod_cep, r.codufmun, r.spatial_resolution_available) for r in found} == {
        ("", "", "sem_localizacao")
    }
    with pytest.raises(ValueError, match="CNES"):
        facility.facility_lookup(registry.drop("CNES"), cases)


def test_facility_lookup_shuffles_each_side_once_after_aggregation(registry, cases):
    text = facility.facility_lookup(registry, cases)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") <= 2 and "Python" not in text


def test_registry_meets_the_case_keys_before_its_aggregate(registry, cases, monkeypatch):
    """A semi-join stands below both aggregates, of the ordinals and of the values at them.

    It is a broadcast within the bound and a shuffle beyond.
    """
    expected = sorted(map(str, facility.facility_lookup(registry, cases).collect()))
    for bound in (None, 0):
        if bound is not None:
            monkeypatch.setattr("geolink.operators.joins.BROADCAST_BYTES", bound)
        lookup = facility.facility_lookup(registry, cases)
        text = lookup._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Aggregate") == text.count("Join LeftSemi") == 2, text
        assert text.index("Aggregate") < text.index("Join LeftSemi")
        assert text.rindex("Aggregate") < text.rindex("Join LeftSemi")
        assert ("strategy=broadcast" in text) == (bound is None)
        assert sorted(map(str, lookup.collect())) == expected


def test_centroids_across_the_meridian(spark):
    corners = [(179, -10), (-179, -10), (-179, -8), (179, -8)]
    rows = [("w", 0, i, float(x), float(y)) for i, (x, y) in enumerate(corners)]
    rows += [("e", 0, i, float(x) - 60, float(y)) for i, (x, y) in enumerate([(2, 2), (4, 2), (4, 4), (2, 4)])]
    table = spark.createDataFrame(rows, "code string, ring int, seq int, x double, y double")
    found = {r.code: (r.centroide_lon, r.centroide_lat) for r in territory.degree_centroids(table, "code").collect()}
    assert abs(found["w"][0]) == pytest.approx(180) and found["w"][1] == pytest.approx(-9, abs=1e-2)
    assert found["e"] == pytest.approx((-57, 3), abs=1e-2)


def test_diagnosis_summary(registry, cases):
    summary = facility.diagnosis_summary(facility.facility_diagnosis(registry, cases))
    found = metric(summary)
    assert found["postal_code", "facilities"] == (3, None)
    assert found["postal_code", "filled"] == (3, 100.0)
    assert found["postal_code", "valid"] == (1, 33.33)
    assert found["postal_code", "valid_unique"] == (1, None)
    assert found["postal_code", "valid_shared"] == (0, None)
    assert found["municipality", "valid"] == (1, 33.33)
    assert found["level", "sem_localizacao"] == (1, 33.33)
    assert verdicts(summary) == {"postal_code": "weak", "municipality": "caution"}
    levels = [n for (section, _), (n, _) in found.items() if section == "level"]
    assert sum(levels) == found["postal_code", "facilities"][0]


def test_diagnosis_summary_of_nothing(registry, cases):
    summary = facility.diagnosis_summary(facility.facility_diagnosis(registry, cases.limit(0)))
    assert {(n or 0, p or 0.0) for n, p in metric(summary).values()} == {(0, 0.0)}


def test_registry_coverage(registry, cases):
    assert tuple(facility.registry_coverage(registry, cases).first()) == (3, 3, 0, 100.0)
    assert tuple(facility.registry_coverage(registry.limit(2), cases).first()) == (3, 1, 2, 33.33)
    assert tuple(facility.registry_coverage(registry, cases.limit(0)).first()) == (0, 0, 0, 0.0)


def test_shared_postal_codes_and_types(spark):
    rows = [(f"{i}", "77693000", i != 3, str(i % 2), "", True, True, "cep") for i in range(6)]
    df = spark.createDataFrame(
        rows,
        "cnes_codigo string, cep_limpo string, cep_valido boolean, TP_UNID string, cod_cep string,"
        " municipio6_valido boolean, uf_valida boolean, spatial_resolution_potencial string",
    ).withColumn("codufmun", F.lit("1"))
    found = metric(facility.diagnosis_summary(df))
    assert found["postal_code", "valid_unique"][0] == found["postal_code", "valid_shared"][0] == 1
    assert [tuple(r) for r in facility.most_frequent(df, "TP_UNID", 1).collect()] == [("0", 3)]


def test_minimal_lookup(spark, cases):
    rows = [
        (" 0000001 ", "A", "-10.5", " -50 ", 2),
        ("0000001", "B", "x", None, 1),
        ("  ", "C", "1", "1", 3),
        (None, "D", "1", "1", 4),
        ("0000002", None, "-1e1", "-50", 5),
    ]
    df = spark.createDataFrame(rows, "co_cnes string, No_Razao string, latitude string, VL_LONGITUDE string, ord int")
    lookup = facility.minimal_lookup(df)
    assert sorted((tuple(r) for r in lookup.collect()), key=str) == [
        ("0000001", "B", None, None), ("0000002", None, -10.0, -50.0),
    ]
    assert tuple(facility.minimal_lookup_completeness(lookup).first()) == (2, 1, 1, 50.0)
    assert tuple(facility.minimal_lookup_completeness(lookup.limit(0)).first()) == (0, None, None, None)
    # The case key "0000002<tab>" keeps its tab here, as the space-only trim does.
    assert tuple(facility.minimal_lookup_coverage(cases, lookup).first()) == (4, 3, 1, 0, 2)
    lacking = [r[0] for r in facility.minimal_lookup_unmatched(cases, lookup).collect()]
    assert lacking == ["0000002\t", "0000009"]
    with pytest.raises(ValueError, match="coordinate"):
        facility.minimal_lookup(df.drop("latitude"))
    with pytest.raises(KeyError):
        facility.minimal_lookup(df.drop("co_cnes"))


# Locations.

UNITS = [
    ("cep", "11111111", "110001", "11"),
    ("failed", "22222222", "110001", "11"),
    ("half", "33333333", "110001", "11"),
    ("mun_without_point", "99999999", "120001", "12"),
    ("uf_only", "99999999", "119999", "11"),
    ("nothing", "99999999", None, None),
    ("half_only", "33333333", "990000", "99"),
    ("blank", "", "110002", "11"),
    ("wrong_state", "99999999", "110001", "12"),
    ("nameless_state", "99999999", "139999", "13"),
    ("nan", "44444444", "110002", "11"),
    ("far", "55555555", "110001", "11"),
]
CACHE = [
    ("11111111", "-12.1", "-62.0", "True", 1),
    ("11111111", "0", "0", "True", 2),
    ("22222222", None, None, "False", 3),
    ("33333333", "-9.5", None, "True", 4),
    ("", "-10.0", "-63.0", "True", 5),
    (None, "7", "7", "True", 6),
    ("44444444", "nan", "-63", "True", 7),
    ("55555555", "-15.803258", "-47.885477", "True", 8),
]


@pytest.fixture(scope="module")
def located(spark, places):
    units = spark.createDataFrame(UNITS, FACILITY)
    points = spark.createDataFrame(CACHE, "cep_limpo string, latitude string, longitude string, geocode_success string, seq int")
    return locate.locate_facilities(units, points, places)


def test_locations(located):
    found = {
        r.cnes_codigo: (r.spatial_resolution_final, r.latitude, r.longitude) for r in located.collect()
    }
    assert found == {
        "cep": ("cep", -12.1, -62.0),
        "failed": ("municipio", -12.0, -62.0),
        "half": ("municipio", -12.0, -62.0),
        "mun_without_point": (None, None, None),
        "uf_only": ("uf", -11.0, -62.5),
        "nothing": (None, None, None),
        "half_only": (None, -9.5, None),
        "blank": ("cep", -10.0, -63.0),
        "wrong_state": (None, None, None),
        "nameless_state": (None, None, None),
        "nan": ("municipio", -10.0, -63.0),
        "far": ("cep", -15.803258, -47.885477),
    }


def test_location_labels(located):
    labels = {(r.spatial_resolution_final, r.spatial_source, r.geocode_quality) for r in located.collect()}
    assert labels == {
        ("cep", "nominatim_cep", "aproximado_por_cep"),
        ("municipio", "ibge_municipio_centroid", "centroide_municipal"),
        ("uf", "ibge_uf_centroid", "centroide_uf"),
        (None, None, None),
    }


def test_location_summary_adds_up(located):
    found = metric(locate.location_summary(located))
    n = {m: v[0] for (_, m), v in found.items()}
    assert n == {"facilities": 12, "cep": 3, "municipio": 3, "uf": 1, "none": 5}
    assert found["level", "cep"][1] == 25.0


def test_location_paths_agree(spark, places, located, monkeypatch):
    """The broadcast path and the staged, shuffled path give the same rows."""
    monkeypatch.setattr("geolink.operators.joins.BROADCAST_BYTES", 0)
    units = spark.createDataFrame(UNITS, FACILITY)
    points = spark.createDataFrame(CACHE, "cep_limpo string, latitude string, longitude string, geocode_success string, seq int")
    other = locate.locate_facilities(units, points, places)
    assert sorted(map(str, other.collect())) == sorted(map(str, located.collect()))


def test_duplicate_municipality_codes_do_not_multiply_rows(spark, places):
    twice = places.unionAll(places.withColumn("municipio_codigo_7", F.lit("9999999")))
    units = spark.createDataFrame(UNITS, FACILITY)
    points = spark.createDataFrame(CACHE, "cep_limpo string, latitude string, longitude string, geocode_success string, seq int")
    assert locate.locate_facilities(units, points, twice).count() == len(UNITS)


def test_plausibility(located, places):
    audited = plausibility.audit_plausibility(located, places)
    found = {r.cnes_codigo: r for r in audited.collect()}
    assert found["failed"].dist_km_to_expected_municipio == 0.0
    assert found["cep"].dist_km_to_expected_municipio == pytest.approx(6371.0 * math.radians(0.1))
    assert found["cep"].dist_gt_25km is False
    far = found["far"]
    assert (far.dist_gt_25km, far.dist_gt_250km, far.candidate_downgrade_to_municipio) == (True,) * 3
    none = found["uf_only"]
    assert none.dist_km_to_expected_municipio is None
    assert (none.dist_gt_25km, none.candidate_downgrade_to_municipio) == (False, False)
    assert found["half_only"].has_coord is False
    summary = plausibility.plausibility_summary(audited)
    n = {k: v[0] for k, v in metric(summary).items()}
    assert n["coverage", "facilities"] == 12 and n["coverage", "with_coordinates"] == 7
    assert n["distance", "gt_100km"] == n["downgrade", "candidates"] == 1
    assert verdicts(summary) == {"distance": "systematic_review", "repeated": "no_collapse"}
    top = [r.cnes_codigo for r in plausibility.top_distances(audited, 3).collect()]
    assert top[:2] == ["far", "cep"]
    sample = plausibility.plausibility_sample(audited).collect()
    assert sample[0].cnes_codigo == "far" and len(sample) == 12


def test_plausibility_without_coordinates(spark, places):
    bare = spark.createDataFrame([("a", "110001", "11")], "cnes_codigo string, municipio_codigo_6 string, uf_codigo string")
    audited = plausibility.audit_plausibility(bare, places)
    assert audited.first().has_coord is False
    assert verdicts(plausibility.plausibility_summary(audited))["distance"] == "coherent"


def test_thresholds_are_exclusive(spark):
    df = spark.createDataFrame([(25.0,), (100.0,), (100.1,)], "d double")
    from geolink.functions.geo import farther_than

    found = df.select(farther_than("d", 25), farther_than("d", 100)).collect()
    assert [tuple(r) for r in found] == [(False, False), (True, False), (True, True)]


def test_repeated_coordinates(spark):
    rows = [(f"{i:03d}", -15.8032581 if i % 2 else -15.8032579, -47.0, f"m{i % 5}", f"u{i % 3}", None if i == 0 else "cep") for i in range(60)]
    rows += [("900", 1.0, 1.0, "m1", "u1", "uf"), ("901", 1.0, 1.0, "m1", "u1", "cep"), ("902", None, 1.0, "m", "u", "cep")]
    df = spark.createDataFrame(
        rows,
        "cnes_codigo string, latitude double, longitude double, municipio_codigo_6 string, uf_codigo string, spatial_resolution_final string",
    ).withColumns(
        {
            "has_coord": F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
            "lat_round6": F.bround("latitude", 6),
            "lon_round6": F.bround("longitude", 6),
        }
    )
    found = [tuple(r) for r in plausibility.top_coordinates(df).collect()]
    assert found == [(-15.803258, -47.0, 60, 5, 3, "cep"), (1.0, 1.0, 2, 1, 1, "uf")]
    assert [tuple(r) for r in plausibility.collapse_counts(df).collect()] == [(10, 1), (25, 1), (50, 1)]


def test_conservative(located, places):
    rebuilt = conservative.conservative_locations(located, places)
    found = {
        r.cnes_codigo: (r.regra_aplicada, r.spatial_resolution_final, r.latitude) for r in rebuilt.collect()
    }
    assert found == {
        "cep": ("manter_cep", "cep", -12.1),
        "failed": ("manter_cep", "cep", -12.0),
        "half": ("manter_cep", "cep", -12.0),
        "mun_without_point": (None, "sem_localizacao", None),
        "uf_only": ("fallback_uf", "uf", -11.0),
        "nothing": (None, "sem_localizacao", None),
        "half_only": (None, "sem_localizacao", None),
        "blank": ("manter_cep", "cep", -10.0),
        "wrong_state": (None, "sem_localizacao", None),
        "nameless_state": (None, "sem_localizacao", None),
        "nan": ("manter_cep", "cep", -10.0),
        "far": ("fallback_municipio", "municipio", -12.0),
    }
    far = rebuilt.where("cnes_codigo = 'far'").first()
    assert (far.latitude_cep_original, far.spatial_resolution_original) == (-15.803258, "cep")
    assert (far.spatial_source, far.geocode_quality) == ("ibge_municipio_centroid", "centroide_municipal")
    kept = rebuilt.where("cnes_codigo = 'failed'").first()
    assert (kept.spatial_source, kept.geocode_quality) == (
        "ibge_municipio_centroid", "aproximado_por_cep_validado",
    )
    n = {m: v[0] for (s, m), v in metric(conservative.conservative_summary(rebuilt)).items() if s != "rule"}
    assert n["cep"] + n["municipio"] + n["uf"] + n["sem_localizacao"] == n["facilities"] == 12
    audited = plausibility.audit_plausibility(located, places)
    assert audited.where("dist_gt_25km").count() == n["municipio"]
    first = conservative.conservative_sample(rebuilt).first()
    assert (first.regra_aplicada, first.cnes_codigo) == ("fallback_municipio", "far")


def test_conservative_by_origin(located, places):
    rebuilt = conservative.conservative_locations(located, places, require_origin="cep")
    rules = {r.cnes_codigo: r.regra_aplicada for r in rebuilt.collect()}
    assert rules["cep"] == "manter_cep" and rules["failed"] == "fallback_municipio"


def test_the_keep_threshold_is_inclusive(spark, places):
    df = spark.createDataFrame([("a", "110001", "11", -12.1, -62.0)], FACILITY.replace("cep_limpo string, ", "") + ", latitude double, longitude double")
    km = plausibility.audit_plausibility(df, places).first().dist_km_to_expected_municipio
    assert conservative.conservative_locations(df, places, keep_km=km).first().regra_aplicada == "manter_cep"
    less = math.nextafter(km, 0)
    assert conservative.conservative_locations(df, places, keep_km=less).first().regra_aplicada == "fallback_municipio"


# Cache.


def test_cache_worklist_and_upsert(spark):
    units = spark.createDataFrame([("33333333",), ("11111111",), ("33333333",), ("00000000",), ("1",), (None,), ("22222222",), ("44444444",)], "cep_limpo string")
    old = spark.createDataFrame([("22222222", None, None, "False", 1), (None, "1", "1", "True", 2)], "cep_limpo string, latitude string, longitude string, geocode_success string, seq int")
    assert [r[0] for r in cache.new_postal_codes(units, old).collect()] == ["11111111", "33333333", "44444444"]
    assert [r[0] for r in cache.new_postal_codes(units, old, cap=1).collect()] == ["11111111"]
    new = spark.createDataFrame([("22222222", "5", "6", True, 1), ("33333333", None, None, False, 2), ("33333333", "7", "8", True, 3)], "cep_limpo string, latitude string, longitude string, geocode_success boolean, seq int")
    merged = {r.cep_limpo: (r.latitude, r.geocode_success) for r in cache.upsert_cache(old, new).collect()}
    assert merged == {"22222222": ("5", "True"), "33333333": ("7", "True"), None: ("1", "True")}


def test_cache_file_and_batches(spark, tmp_path):
    path = tmp_path / "cache.csv"
    assert cache.load_cache(spark, str(path)).count() == 0
    path.write_text("cep_limpo,latitude,longitude,geocode_success\n01001000,1.5,2.5,True\n01001000,9,9,True\n,3,4,False\n")
    loaded = {r.cep_limpo: r for r in cache.load_cache(spark, str(path)).collect()}
    assert loaded["01001000"].latitude == "1.5" and loaded["01001000"].geocode_source is None
    assert loaded[""].latitude == "3"
    saved = str(tmp_path / "results")
    for batch, lat in enumerate(("1", "2")):
        cache.append_results(spark.createDataFrame([("1", lat)], "cep_limpo string, latitude string"), saved, batch)
    assert [r.latitude for r in cache.read_results(spark, saved).collect()] == ["2"]


# Dictionary.


def test_dictionary_from_cells(spark):
    rows = [
        (0, 0, ["Campo", " label \n", " ID_AGRAVO ", "1 - Sim\n2 – Não", "TP_NOT"]),
        (0, 1, ["DT_ONLY"]),
        (1, 0, ["x", None, "ID_AGRAVO"]),
        (1, 1, ["x", "no name", "id_lower", None]),
        (1, 2, None),
    ]
    df = spark.createDataFrame(rows, "page int, row int, cells array<string>")
    found = {r.name: tuple(r)[1:] for r in dictionary.dictionary_from_cells(df).collect()}
    assert found == {
        "ID_AGRAVO": ("", {}, 2),
        "TP_NOT": ("label", {"1": "Sim", "2": "Não"}, 1),
        "DT_ONLY": ("Label não capturado", {}, 1),
    }


def test_schema_audit(spark):
    table = spark.createDataFrame([], "A string, B string, ID_AGRAVO string")
    document = {"external_lookup_variables": ["ID_AGRAVO"], "variables": {"A": {}, "C": {}}}
    counts, one_sided = dictionary.audit_table_schema(table, document)
    assert {m: v[0] for (_, m), v in metric(counts).items()} == {
        "observed": 3, "declared": 3, "in_both": 2, "observed_only": 1, "declared_only": 1,
    }
    assert sorted(tuple(r) for r in one_sided.collect()) == [("declared_only", "C"), ("observed_only", "B")]


def test_load_summary(cases):
    found = metric(dictionary.load_summary(cases, 119, 12))
    assert [v[0] for v in found.values()] == [6, 8, 119, 12]


# Territory.


def test_territory_lookup(spark):
    mesh = spark.createDataFrame(
        [("1100015", "Mesh", "RO"), ("1200013", "Other", None), ("11000", "bad", "RO"), ("1300029", "x", "AM")],
        "cd_mun string, Nm_Mun string, SIGLA_UF string",
    )
    official = spark.createDataFrame([("1100015", "Official"), ("1200013", None), ("11000", "bad")], "municipio_codigo_7 string, municipio_nome_api string")
    square = [("1100015", i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (2, 0), (2, 2), (0, 2)])]
    vertices = spark.createDataFrame(square, "poly string, seq int, x double, y double")
    found = {r.municipio_codigo_7: r for r in territory.territory_lookup(mesh, official, vertices).collect()}
    assert set(found) == {"1100015", "1200013"}
    a, b = found["1100015"], found["1200013"]
    assert (a.municipio_nome, a.municipio_codigo_6, a.uf_codigo, a.uf_nome) == ("Official", "110001", "11", "Rondônia")
    assert (a.centroide_lon, a.centroide_lat) == pytest.approx((1.0, 1.0), abs=1e-3)
    assert (b.municipio_nome, b.uf_sigla, b.centroide_lat) == ("Other", "AC", None)
    assert "area_km2" not in territory.territory_lookup(mesh, official, vertices).columns
    planar = vertices.withColumn("x", F.col("x") * 1000)
    with pytest.raises(Exception, match="in degrees"):
        territory.territory_lookup(mesh, official, planar).collect()
    with pytest.raises(ValueError, match="NM_MUN"):
        territory.territory_lookup(mesh.drop("Nm_Mun"), official, vertices)


def test_state_centroids_and_counts(places):
    states = {r.uf_codigo: (r.uf_lat, r.uf_lon) for r in territory.state_centroids(places).collect()}
    assert states == {"11": (-11.0, -62.5), "12": (None, -67.0)}
    total, per_state, first = inspection.territory_facts(places, 2)
    assert total.first().n == 4
    assert [tuple(r) for r in per_state.collect()] == [("AC", 1), ("RO", 2), (None, 1)]
    assert [r.municipio_codigo_7 for r in first.collect()] == ["1100015", "1100023"]


# Enrichment.


def test_enriched_cases(spark, cases, places, located):
    units = located.where("cnes_codigo = 'cep'").withColumn("cnes_codigo", F.lit("0000001"))
    enriched = enrich.enrich_cases(cases, places, units)
    assert enriched.count() == len(CASE_ROWS)
    assert enriched.columns[:8] == cases.columns
    added = enriched.columns[8:]
    assert len(added) == 21 + 20 + 5
    assert added[:7] == [f"municipio_residencia_{c}" for c in ("nome", "uf_codigo", "uf_sigla", "uf_nome", "lon", "lat", "area_km2")]
    assert added[-5:] == list(enrich.PROVENANCE)
    found = {r.case_id: r for r in enriched.collect()}
    assert found[1].municipio_residencia_nome == "Alta"
    assert found[2].municipio_residencia_nome is None  # The key keeps its trailing space.
    assert found[1].unidade_latitude == found[2].unidade_latitude == -12.1
    assert found[3].unidade_latitude is None
    assert {r.integration_layer for r in found.values()} == {"SINAN+IBGE+CNES"}
    trimmed = enrich.enrich_cases(cases, places, units, trim_keys=True)
    assert trimmed.where("case_id = 2").first().municipio_residencia_nome == "Alta"
    n = {m: v[0] for (_, m), v in metric(enrich.enriched_summary(enriched)).items()}
    assert n == {"rows": 6, "columns": 54, "residence_located": 3, "notification_located": 5, "facility_located": 2}
    sample = enrich.enriched_sample(enriched, "case_id", 2).collect()
    assert [r.case_id for r in sample] == [1, 2]


def test_enrichment_paths_agree(cases, places, located):
    units = located.where("cnes_codigo = 'cep'").withColumn("cnes_codigo", F.lit("0000001"))
    small = enrich.enrich_cases(cases, places, units)
    large = enrich.enrich_cases(cases, places, units, max_broadcast_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


@pytest.mark.parametrize("trim", [False, True])
def test_enrichment_from_buckets_agrees(cases, places, located, tmp_path, trim):
    units = located.where("cnes_codigo = 'cep'").withColumn("cnes_codigo", F.lit("0000001"))
    spark, paths = cases.sparkSession, [f"{tmp_path}/places", f"{tmp_path}/units"]
    bucketed.write_bucketed(places, paths[0], "municipio_codigo_6", 5)
    bucketed.write_bucketed(units, paths[1], "cnes_codigo", 5)
    lookups = [bucketed.read_bucketed(spark, p) for p in paths]
    found = enrich.enrich_cases_bucketed(cases, *lookups, trim_keys=trim)
    expected = enrich.enrich_cases(cases, places, units, trim_keys=trim)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_enrichment_does_not_shuffle_the_cases(cases, places, located):
    text = enrich.enrich_cases(cases, places, located)._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in text
    fact_side = text.split("ExistingRDD[case_id")[0]
    assert "ArrowEval" not in text and "BatchEvalPython" not in text and fact_side


def test_repeated_territory_code_is_an_error(cases, places, located):
    with pytest.raises(ValueError, match="repeated"):
        enrich.enrich_cases(cases, places.unionAll(places), located)


def test_area_is_optional(cases, places, located):
    enriched = enrich.enrich_cases(cases, places.drop("area_km2"), located)
    assert enriched.first().municipio_residencia_area_km2 is None


# Inspection.


def test_schema_scan(spark, tmp_path):
    rows = [
        ("ST", "STSP2601.dbc", "COD_CEP", "1"),
        ("ST", "STSP2601.dbc", "S_RECEPC", "2"),
        ("ST", "STSP2601.dbc", "CNES", "3"),
        ("ST", "STSP2512.dbc", "NOME", "4"),
        ("ST", "STufAAmm.dbc", "NOME", "5"),
        ("EP", "EPSP2601.dbc", "CNES", "6"),
    ]
    df = spark.createDataFrame(rows, "grupo string, arquivo string, coluna string, primeiro string")
    found = sorted((tuple(r) for r in inspection.scan_inventory(df).collect()), key=str)
    assert found == [
        ("EP", "EPSP2601.dbc", 1, None, None),
        ("ST", "STSP2601.dbc", 3, "COD_CEP", "1"),
        ("ST", "STSP2601.dbc", 3, "S_RECEPC", "2"),
    ]
    path = str(tmp_path / "STSP2601")
    spark.createDataFrame([("7", 1)], "cod_cep string, v int").write.parquet(path)
    plain = str(tmp_path / "EPSP2601")
    spark.createDataFrame([(1,)], "v int").write.parquet(plain)
    scanned = inspection.scan_groups(spark, {"ST": path, "EP": plain}).collect()
    assert sorted((tuple(r) for r in scanned), key=str) == [
        ("EP", "EPSP2601", 1, None, None), ("ST", "STSP2601", 2, "cod_cep", "7"),
    ]


def test_file_facts(cases):
    facts = inspection.file_facts(cases, "cases").first()
    assert (facts.n_rows, facts.n_columns, facts.columns) == (6, 8, ",".join(cases.columns))
    assert [r.case_id for r in inspection.first_rows(cases, ["case_id"]).collect()] == [1, 2, 3]
