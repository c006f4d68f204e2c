"""Column expressions on literals, with the edge cases of the key and distance rules."""

import math

import pytest
from pyspark.sql import functions as F

from geolink.functions import geo, keys, ratios


@pytest.fixture(scope="module")
def evaluate(spark):
    def run(expression, value, kind="string"):
        df = spark.createDataFrame([(value,)], f"v {kind}")
        return df.select(expression(F.col("v"))).first()[0]

    return run


@pytest.mark.parametrize(
    ("function", "value", "expected"),
    [
        (keys.trimmed, " 12 ", "12"),
        (keys.trimmed, "\t12\t", "\t12\t"),
        (keys.stripped, " \t12\r\n", "12"),
        (keys.stripped, None, None),
        (keys.is_filled, None, False),
        (keys.is_filled, "  ", False),
        (keys.is_filled, "\t", True),
        (keys.is_filled, " x", True),
        (keys.only_digits, None, ""),
        (keys.only_digits, "77.693-000", "77693000"),
        (keys.only_digits, "x١٢9", "9"),
        (keys.is_postal_code, "77.693-000", True),
        (keys.is_postal_code, "00000-000", False),
        (keys.is_postal_code, "7769300", False),
        (keys.is_postal_code, "776930001", False),
        (keys.is_postal_code, None, False),
        (keys.is_municipality6, "110001", True),
        (keys.is_municipality6, "000000", False),
        (keys.is_municipality6, "11000", False),
        (keys.is_state2, "11", True),
        (keys.is_state2, "00", False),
        (keys.is_state2, "1", False),
        (keys.is_municipality7, "1100015", True),
        (keys.is_municipality7, "11000151", False),
        (keys.is_municipality7, "110001X", False),
        (keys.without_last, "1100015", "110001"),
        (lambda c: keys.prefix(c, 2), "1100015", "11"),
        (lambda c: keys.zero_pad(c, 2), "9", "09"),
        (lambda c: keys.zero_pad(c, 2), "123", "12"),
        (lambda c: keys.zero_fill(c, 2), "9", "09"),
        (lambda c: keys.zero_fill(c, 2), "123", "123"),
        (keys.to_number, " -15.5 ", -15.5),
        (keys.to_number, "1e2", 100.0),
        (keys.to_number, ".5", 0.5),
        (keys.to_number, "5.", 5.0),
        (keys.to_number, "1.5d", None),
        (keys.to_number, "nan", None),
        (keys.to_number, "", None),
        (keys.to_number, "n/d", None),
        (keys.is_variable_name, " ID_AGRAVO ", True),
        (keys.is_variable_name, "ID", False),
        (keys.is_variable_name, "Id_agravo", False),
        (keys.is_variable_name, "A" * 17, False),
        (keys.geocode_query, "77693000", "77693000, Brazil"),
        (keys.name_year, "STSP2601.dbc", "26"),
        (keys.name_month, "STSP2601.dbc", "01"),
        (keys.has_period, "STSP2601.dbc", True),
        (keys.has_period, "STufAAmm.dbc", False),
        (lambda c: keys.name_matches(c, "ST", ".dbc"), "stTO2512.DBC", True),
        (lambda c: keys.name_matches(c, "ST", ".dbc"), "EPTO2512.DBC", False),
    ],
)
def test_text_expression(evaluate, function, value, expected):
    assert evaluate(function, value) == expected


def test_flag_text_and_period(evaluate):
    assert evaluate(keys.flag_text, True, "boolean") == "True"
    assert evaluate(keys.flag_text, False, "boolean") == "False"
    assert evaluate(lambda c: keys.period_label(c, 1), 2026, "int") == "2026-01"
    assert evaluate(lambda c: keys.period_label(2026, c), 12, "int") == "2026-12"


def test_finite_drops_nan_only(evaluate):
    assert evaluate(keys.finite, float("nan"), "double") is None
    assert evaluate(keys.finite, None, "double") is None
    assert evaluate(keys.finite, 1.5, "double") == 1.5


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1 - Sim 2 – Não", {"1": "Sim ", "2": "Não"}),
        ("1-a\n2-b\n1-c", {"1": "c", "2": "b"}),
        ("10 -x 1- y", {"10": "x ", "1": "y"}),
        ("no codes", {}),
        (None, {}),
    ],
)
def test_code_label_map_last_wins(evaluate, text, expected):
    assert evaluate(keys.code_label_map, text) == expected


@pytest.mark.parametrize(
    ("flags", "expected"),
    [
        ((True, True, True), "cep"),
        ((True, False, False), "cep"),
        ((False, True, True), "municipio"),
        ((False, False, True), "uf"),
        ((False, False, False), "sem_localizacao"),
    ],
)
def test_level_ladder(spark, flags, expected):
    df = spark.createDataFrame([flags], "p boolean, m boolean, s boolean")
    level = keys.level_available(F.col("p"), F.col("m"), F.col("s"))
    assert df.select(level).first()[0] == expected


def python_haversine(lat1, lon1, lat2, lon2):
    a = (
        math.sin(math.radians(lat2 - lat1) / 2) ** 2
        + math.cos(math.radians(lat1))
        * math.cos(math.radians(lat2))
        * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(a)))


def test_haversine(spark):
    points = [
        (-10.0, -50.0, -11.0, -51.0),
        (0.0, 0.0, 0.0, 180.0),
        (45.0, 10.0, -45.0, -170.0),
        (-23.5, -46.6, -23.5, -46.6),
        (89.9, 0.0, -89.9, 1.0),
    ]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    found = [r[0] for r in df.select(geo.haversine_km("a", "b", "c", "d")).collect()]
    assert found == pytest.approx([python_haversine(*p) for p in points], abs=1e-6)
    assert found[3] == 0.0
    assert found[1] == pytest.approx(math.pi * 6371.0)


@pytest.mark.parametrize("missing", [None, float("nan")])
@pytest.mark.parametrize("position", range(4))
def test_haversine_of_a_missing_coordinate_is_null(spark, position, missing):
    row = [1.0, 2.0, 3.0, 4.0]
    row[position] = missing
    df = spark.createDataFrame([tuple(row)], "a double, b double, c double, d double")
    assert df.select(geo.haversine_km("a", "b", "c", "d")).first()[0] is None


def test_distance_flags_and_points(spark):
    df = spark.createDataFrame([(25.0,), (25.000001,), (None,)], "km double")
    assert [r[0] for r in df.select(geo.farther_than("km", 25)).collect()] == [False, True, False]
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (None, None)], "a double, b double")
    found = df.select(
        geo.both_present("a", "b"), geo.usable_point(F.col("a"), F.col("b")).isNotNull()
    ).collect()
    assert [tuple(r) for r in found] == [(True, True), (False, False), (False, False)]


def test_percentages_are_half_even_like_python(spark):
    pairs = [(n, d) for d in range(0, 129) for n in range(d + 1)]
    df = spark.createDataFrame(pairs, "n long, d long")
    for row in df.select("n", "d", ratios.pct("n", "d").alias("p")).collect():
        assert row.p == (round(100.0 * row.n / row.d, 2) if row.d else 0.0)


def test_sql_percentage_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 32), (0, 0)], "n long, d long")
    assert [r[0] for r in df.select(ratios.pct_half_up("n", "d")).collect()] == [3.13, None]


def test_bands(spark):
    df = spark.createDataFrame([(49.99,), (50.0,), (80.0,)], "p double")
    verdict = ratios.banded("p", "weak", (50.0, "usable"), (80.0, "strong"))
    assert [r[0] for r in df.select(verdict).collect()] == ["weak", "usable", "strong"]
