"""Table-level operators on small tables: order, missing values, repeated and hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from geolink.operators import (
    bucketed,
    centroid,
    dedupe,
    joins,
    metrics,
    projection,
    ranking,
    stacking,
    staging,
)
from geolink.operators.joins import Side


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(spark, data, schema, seed):
    data = list(data)
    random.Random(seed).shuffle(data)
    return spark.createDataFrame(data, schema).repartition(3)


REGISTRY = [
    ("a", None, "x1", 1),
    ("a", "  ", "", 2),
    ("a", "c3", "x3", 3),
    ("a", "c4", None, 4),
    ("b", " ", None, 5),
    ("b", None, "y6", 6),
]


@pytest.mark.parametrize("seed", range(3))
def test_first_filled_is_per_column_and_independent_of_input_order(spark, seed):
    df = shuffled(spark, REGISTRY, "k string, c string, x string, ord long", seed)
    found = dedupe.first_filled_per_key(df, "k", "ord").drop("ord")
    assert rows(found, "k") == [("a", "c3", "x1"), ("b", None, "y6")]


@pytest.mark.parametrize("seed", range(3))
def test_first_filled_by_another_kind_of_ordinal(spark, seed):
    df = shuffled(spark, REGISTRY, "k string, c string, x string, ord long", seed)
    df = df.withColumn("ord", F.struct(F.lit("file"), "ord"))
    found = dedupe.first_filled_per_key(df, "k", "ord").drop("ord")
    assert rows(found, "k") == [("a", "c3", "x1"), ("b", None, "y6")]


def test_first_filled_aggregates_before_the_shuffle(spark):
    df = spark.createDataFrame(REGISTRY, "k string, c string, x string, ord long")
    text = plan(dedupe.first_filled_per_key(df.withColumn("ord", F.struct("ord")), "k", "ord"))
    assert "partial_min_by" in text and text.count("Exchange") == 1


def test_first_filled_by_number_neither_sorts_nor_aggregates_texts(spark):
    df = spark.createDataFrame(REGISTRY, "k string, c string, x string, ord long")
    text = plan(dedupe.first_filled_per_key(df, "k", "ord", F.broadcast))
    assert "SortAggregate" not in text and "Sort " not in text and "min_by" not in text
    assert "HashAggregate" in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("hint", [F.broadcast, lambda df: df])
def test_first_filled_of_a_hot_key_keys_without_values_and_gaps(spark, hint):
    """A key with a third of all rows, the null key, a key of blanks only, rows without an ordinal."""
    data = [("hot", "v" if i >= 700 else " ", None if i != 900 else "x", i) for i in range(1000)]
    data += [(f"k{i % 500}", str(i), "", 1000 + i) for i in range(2000)]
    data += [(None, None, "n2", 5001), (None, "c1", None, 5000), ("blank", " ", None, 6000)]
    data += [("late", "last", None, None), ("late", "first", None, 7000), ("only", "o", None, None)]
    df = shuffled(spark, data, "k string, c string, x string, ord long", 1)
    found = {r.k: (r.c, r.x) for r in dedupe.first_filled_per_key(df, "k", "ord", hint).collect()}
    expected = {f"k{i}": (str(i), None) for i in range(500)}
    expected |= {"hot": ("v", "x"), None: ("c1", "n2"), "blank": (None, None)}
    assert found == expected | {"late": ("first", None), "only": ("o", None)}
    assert dedupe.first_filled_per_key(df.limit(0), "k", "ord", hint).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_keep_first_and_last(spark, seed):
    data = [("a", 3, "c"), ("a", 1, "a"), ("a", None, "n"), (None, 2, "z"), (None, 1, "y")]
    df = shuffled(spark, data, "k string, o int, v string", seed)
    assert rows(dedupe.keep_first(df, ["k"], "o").select("v")) == [("a",), ("y",)]
    assert rows(dedupe.keep_last(df, ["k"], "o").select("v")) == [("c",), ("z",)]


def test_keep_one_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, o int")
    text = plan(dedupe.keep_first(df, ["k"], "o"))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert rows(dedupe.duplicate_keys(df, ["k"])) == [("a", 2)]
    with pytest.raises(ValueError, match="repeated keys"):
        dedupe.require_unique(df, ["k"])
    assert dedupe.require_unique(df, ["k", "v"]) is df


FACT = [("a", 1), ("b", 2), ("z", 3), (None, 4), ("a", 5)]
LOOKUP = [("a", "A"), ("b", "B"), ("c", "C"), (None, "N")]


@pytest.mark.parametrize("bound", [None, 0])
def test_join_lookups_keeps_every_fact_row_on_both_paths(spark, bound):
    fact = spark.createDataFrame(FACT, "k string, v int")
    lookup = spark.createDataFrame(LOOKUP, "k string, name string")
    joined = joins.join_lookups(fact, Side(lookup, ["k"]), max_broadcast_bytes=bound)
    assert rows(joined.select("v", "name"), "v") == [
        (1, "A"), (2, "B"), (3, None), (4, None), (5, "A"),
    ]


def test_small_lookup_is_broadcast(spark):
    fact = spark.range(10).select(F.col("id").cast("string").alias("k"))
    lookup = spark.createDataFrame(LOOKUP, "k string, name string")
    text = plan(joins.join_lookups(fact, Side(lookup, ["k"])))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_hot_key_of_a_large_lookup_is_split(spark):
    """Beyond the broadcast bound, a key with a third of all rows is split over tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
        pad = F.sha2(F.col("id").cast("string"), 256).alias("pad")
        fact = spark.range(0, n, 1, 12).select("id", key.alias("k"), pad)
        lookup = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
        joined = joins.join_lookups(fact, Side(lookup, ["k"]), max_broadcast_bytes=0)
        found = joined.where("twice = 2 * k").collect()
        assert len(found) == n
        joined.collect()
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_bucketed_lookup_is_not_shuffled_and_hot_keys_are_dealt(spark, tmp_path):
    """A key with a third of the rows, a hot key that the lookup lacks, and rows without a key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    names = [(str(i), f"name {i}", i * 0.5) for i in range(400)] + [("null", None, None)]
    path = str(tmp_path / "lookup")
    bucketed.write_bucketed(spark.createDataFrame(names, "k string, name string, `a b` double"), path, "k", 8)
    lookup = bucketed.read_bucketed(spark, path)
    assert sorted(map(str, lookup.collect())) == sorted(map(str, [r for r in spark.read.parquet(path).collect()]))
    key = F.expr("CASE WHEN id % 3 = 0 THEN '7' WHEN id % 3 = 1 AND id % 2 = 0 THEN 'gone' WHEN id % 5 > 0 THEN cast(id % 500 AS string) END")
    fact = spark.range(0, 6000, 1, 6).select("id", key.alias("key"), F.lit("x").alias("k2"))
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for most in (0, 2, 1000):
            joined = bucketed.join_bucketed(fact, lookup, "k", F.col("key"), most=most)
            assert joined.columns == ["id", "key", "k2", "name", "a b"]
            known = {k: rest for k, *rest in names}
            expected = [(r.id, r.key, r.k2, *known.get(r.key, (None, None))) for r in fact.collect()]
            assert sorted(map(tuple, joined.collect())) == sorted(expected)
        text = plan(bucketed.join_bucketed(fact, lookup, "k", F.col("key"), most=2))
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
        # The rows of hot keys and those without a key lie in all partitions.
        sizes = bucketed.join_bucketed(fact, lookup, "k", F.col("key"), most=2).groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in sizes.collect()) < 6000 / 3
        with pytest.raises(ValueError, match="name"):
            bucketed.join_bucketed(fact.withColumn("name", F.lit(1)), lookup, "k", F.col("key"))
        assert bucketed.join_bucketed(fact.limit(0), lookup, "k", F.col("key")).count() == 0
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_repeated_lookup_key_is_an_error(spark):
    fact = spark.createDataFrame(FACT, "k string, v int")
    lookup = spark.createDataFrame([("a", "A"), ("a", "B")], "k string, name string")
    with pytest.raises(ValueError, match="repeated"):
        joins.join_lookups(fact, Side(lookup, ["k"]))


def test_repeated_null_keys_match_nothing_and_are_no_error(spark):
    fact = spark.createDataFrame(FACT, "k string, v int")
    lookup = spark.createDataFrame([(None, "A"), (None, "B")], "k string, name string")
    assert joins.join_lookups(fact, Side(lookup, ["k"])).count() == len(FACT)


def test_measured_bytes_cover_the_text(spark):
    lookup = spark.createDataFrame([("a", "é" * 10), ("b", None)], "k string, name string")
    (size, per_key), (source_size, _) = joins.measure(
        [Side(lookup, ["k"]), Side(lookup.limit(1), ["k"], lookup)]
    )
    assert size == source_size == 2 * 48 + 2 + 20
    assert per_key == 1


def test_suffix_clashes(spark):
    fact = spark.createDataFrame([("a", 1)], "k string, name int")
    lookup = spark.createDataFrame(LOOKUP, "k string, name string")
    assert joins.suffix_clashes(fact, lookup, ["k"], "_x").columns == ["k", "name_x"]


def test_semi_and_anti_join(spark):
    fact = spark.createDataFrame(FACT, "k string, v int")
    lookup = spark.createDataFrame(LOOKUP, "k string, name string")
    assert rows(joins.matching(fact, lookup, ["k"]).select("v")) == [(1,), (2,), (5,)]
    assert rows(joins.missing(fact, lookup, ["k"]).select("v")) == [(3,), (4,)]


def test_translate(spark):
    df = spark.createDataFrame([("cep",), ("x",), (None,)], "k string")
    found = df.select(joins.translate(F.col("k"), {"cep": "C", "uf": "U"})).collect()
    assert [r[0] for r in found] == ["C", None, None]


def test_stack_strict(spark):
    a = spark.createDataFrame([("a", 1)], "k string, v int")
    b = spark.createDataFrame([(2, "b")], "v int, k string")
    assert rows(stacking.stack_strict([a, b])) == [("a", 1), ("b", 2)]
    for other in ("k string, v long", "k string", "k string, v int, w int"):
        with pytest.raises(ValueError, match="differs"):
            stacking.stack_strict([a, spark.createDataFrame([], other)])
    with pytest.raises(ValueError, match="no input"):
        stacking.stack_strict([])


def test_stack_aligned(spark):
    a = spark.createDataFrame([("a", 1)], "k string, v int")
    b = spark.createDataFrame([("b", True)], "k string, w boolean")
    assert rows(stacking.stack_aligned([a, b])) == [("a", 1, None), ("b", None, True)]


def test_compare_names(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "name string")
    b = spark.createDataFrame([("y",), ("z",)], "name string")
    assert rows(stacking.compare_names(a, b)) == [
        ("x", True, False), ("y", True, True), ("z", False, True),
    ]


def test_projection(spark):
    df = spark.createDataFrame([("a", 1)], "Co_Cnes string, v int")
    assert projection.keep_existing(df, ["v", "nope"]).columns == ["v"]
    out = projection.with_defaults(df, {"v": ("int", 9), "w": ("string", "")})
    assert rows(out) == [("a", 1, "")]
    assert projection.with_null_texts(df, ["t"]).first().t is None
    assert projection.with_constants(df, {"s": "x"}).first().s == "x"
    assert projection.pick_column(df, ["CNES", "CO_CNES"]) == "Co_Cnes"
    assert projection.pick_column(df, ["X"], required=False) is None
    with pytest.raises(KeyError, match="Co_Cnes"):
        projection.pick_column(df, ["X"])
    with pytest.raises(ValueError, match="available"):
        projection.require_columns(df, ["X"])


def test_top_n_has_nulls_last_and_unique_ties(spark):
    data = [("a", None), ("b", 2.0), ("c", 2.0), ("d", 3.0)]
    df = spark.createDataFrame(data, "k string, v double")
    assert [r.k for r in ranking.top_n(df, 3, ["v"], ["k"]).collect()] == ["d", "b", "c"]
    assert [r.k for r in ranking.top_n(df, 9, ["v"], ["k"]).collect()] == ["d", "b", "c", "a"]
    assert "TakeOrderedAndProject" in plan(ranking.top_n(df, 3, ["v"], ["k"]))


def test_top_n_per_group(spark):
    data = [("a", i) for i in range(9)] + [("b", 1), (None, 5), (None, 4)]
    df = spark.createDataFrame(data, "g string, v int")
    found = ranking.top_n_per_group(df, "g", 2, ascending=["v"])
    assert rows(found) == [(None, 4), (None, 5), ("a", 0), ("a", 1), ("b", 1)]
    assert "WindowGroupLimit" in plan(found)


def test_metrics(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int").agg(
        *metrics.counts(n=F.lit(True), big=F.col("v") > 1)
    )
    found = metrics.metrics_long(
        df,
        [
            metrics.count_metric("s", "big", F.col("big"), F.col("n")),
            metrics.count_metric("s", "all", F.col("n")),
            metrics.verdict_metric("s", "v", F.lit("ok")),
        ],
    )
    assert [tuple(r) for r in found.collect()] == [
        ("s", "big", 1, 50.0, None), ("s", "all", 2, None, None), ("s", "v", None, None, "ok"),
    ]


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]


def vertices(spark, *polygons):
    data = [
        (name, ring, i, float(x), float(y))
        for name, rings in polygons
        for ring, points in enumerate(rings)
        for i, (x, y) in enumerate(points)
    ]
    return spark.createDataFrame(data, "poly string, ring int, seq int, x double, y double")


def test_centroids(spark):
    hole = [(1, 1), (1, 2), (2, 2), (2, 1)]
    table = vertices(
        spark,
        ("open", [SQUARE]),
        ("closed", [[*SQUARE, SQUARE[0]]]),
        ("clockwise", [SQUARE[::-1]]),
        ("holed", [SQUARE, hole]),
        ("two_parts", [SQUARE, [(x + 10, y) for x, y in SQUARE]]),
        ("line", [[(0, 0), (4, 0)]]),
        ("point", [[(7, 9)]]),
        ("far", [[(x + 5e6, y + 9e6) for x, y in SQUARE]]),
    ).repartition(3)
    found = {r.poly: (r.x, r.y) for r in centroid.polygon_centroids(table).collect()}
    # A 4x4 square minus the unit square centred on (1.5, 1.5).
    holed = (16 * 2 - 1.5) / 15
    assert found == {
        "open": (2, 2),
        "closed": (2, 2),
        "clockwise": (2, 2),
        "holed": (pytest.approx(holed), pytest.approx(holed)),
        "two_parts": (7, 2),
        "line": (2, 0),
        "point": (7, 9),
        "far": (pytest.approx(5e6 + 2), pytest.approx(9e6 + 2)),
    }


@pytest.mark.parametrize("size", [2, 3, 7, 1000])
def test_centroids_do_not_depend_on_the_piece_size(spark, monkeypatch, size):
    monkeypatch.setattr(centroid, "PIECE_SIZE", size)
    ring = [(i * i % 37, i) for i in range(12)] + [(-5 - i % 3, 12 - i) for i in range(12)]
    shifted = [(x + 100, y - 40) for x, y in ring]
    table = vertices(spark, ("a", [ring]), ("b", [ring, shifted]), ("square", [SQUARE]))
    # The pieces may start anywhere in the numbering.
    table = table.withColumn("seq", F.col("seq") - 5).repartition(3)
    found = {r.poly: (r.x, r.y) for r in centroid.polygon_centroids(table).collect()}
    cross = [(a[0] * b[1] - b[0] * a[1], a, b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    area2 = sum(c for c, _, _ in cross)
    x = sum((a[0] + b[0]) * c for c, a, b in cross) / (3 * area2)
    y = sum((a[1] + b[1]) * c for c, a, b in cross) / (3 * area2)
    assert found["a"] == pytest.approx((x, y))
    assert found["b"] == pytest.approx((x + 50, y - 20))
    assert found["square"] == pytest.approx((2, 2))


def test_holes_are_told_by_where_they_lie(spark):
    """Either way round, nested, beside each other; an island in a hole counts."""
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    hole = [(1, 1), (2, 1), (2, 2), (1, 2)]

    def scaled(points, k, dx=0, dy=0):
        return [(x * k + dx, y * k + dy) for x, y in points]

    island = scaled(square, 0.1, 1.2, 1.2)
    cases = {
        "same_way": [square, hole],
        "other_way": [square, hole[::-1]],
        "shell_reversed": [square[::-1], hole],
        "hole_first": [hole, square],
        "island": [square, hole, island],
        "island_reversed": [square, hole[::-1], island[::-1]],
        "apart": [square, scaled(hole, 1, 10, 0)],
        "apart_reversed": [square, scaled(hole, 1, 10, 0)[::-1]],
    }
    table = vertices(spark, *cases.items()).repartition(3)
    found = {r.poly: (r.x, r.y) for r in centroid.polygon_centroids(table).collect()}
    holed = (16 * 2 - 1.5) / 15
    for name in ("same_way", "other_way", "shell_reversed", "hole_first"):
        assert found[name] == pytest.approx((holed, holed))
    nested = (16 * 2 - 1.5 + 0.16 * 1.4) / (15 + 0.16)
    assert found["island"] == pytest.approx((nested, nested)) == found["island_reversed"]
    assert found["apart"] == pytest.approx(((32 + 11.5) / 17, (32 + 1.5) / 17)) == found["apart_reversed"]


def test_stage_table_cuts_lineage(spark):
    df = spark.range(5).select(F.col("id"), (F.col("id") * 2).alias("twice"))
    staged = staging.stage_table(df, "test")
    assert rows(staged) == rows(df)
    assert "FileScan parquet" in plan(staged) and "Range" not in plan(staged)


@pytest.mark.parametrize("step", [1, 10, 9_999, 10_001, 20_000, 10**9])
def test_centroids_with_gaps_in_the_numbering(spark, step):
    corners = [(0, 0), (4, 0), (4, 2), (0, 2)]
    rows = [(1, i * step, float(x), float(y)) for i, (x, y) in enumerate(corners)]
    table = spark.createDataFrame(rows, "poly int, seq long, x double, y double")
    row = centroid.polygon_centroids(table).first()
    assert (row.x, row.y) == pytest.approx((2, 1))


def test_first_filled_passes_over_tabs(spark):
    rows = [("k", "\t", 1), ("k", " \n", 2), ("k", "77", 3)]
    table = spark.createDataFrame(rows, "key string, code string, ord int")
    assert dedupe.first_filled_per_key(table, "key", "ord").first().code == "77"


def test_numbers_of_all_rows(spark):
    values = [None, *range(50), 7, 7] * 3
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").repartition(5)
    rows = ranking.numbered(df, "n", ranking.order_columns(["v"], ["i"])).orderBy("n").collect()
    expected = sorted(((v, i) for i, v in enumerate(values)), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.v, r.i) for r in rows] == expected
    assert [r.n for r in rows] == list(range(1, len(values) + 1))
    assert ranking.numbered(df.limit(0), "n", ranking.order_columns(["v"])).count() == 0
