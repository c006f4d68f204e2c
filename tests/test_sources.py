"""Readers, file choice, payloads, dictionary documents and writers."""

import json

import pytest
from pyspark.sql import functions as F

from geolink.operators.staging import shared_folder
from geolink.plans import cache as cache_plans
from geolink.plans import cases as case_plans
from geolink.plans import inspection
from geolink.sources import dictionary, files, footers, payload, sinks, tables

NAMES = [
    "STSP2601.dbc",
    "STTO2512.DBC",
    "stRJ2601.dbc",
    "STufAAmm.dbc",
    "EPSP2601.dbc",
    "STAC2601.dbf",
    "STAC2601.dbc",
]


def chosen(df):
    return [r.name for r in df.collect()]


def test_select_files(spark):
    table = spark.createDataFrame([(n,) for n in NAMES], "name string")
    found = files.select_files(table, "ST", 2026, 1)
    assert chosen(found) == ["STAC2601.dbc", "STSP2601.dbc", "stRJ2601.dbc"]
    assert chosen(files.select_files(table, "ST", 2026, 1, cap=1)) == ["STAC2601.dbc"]
    assert chosen(files.select_files(table, "ST", 2025, 12)) == ["STTO2512.DBC"]
    assert chosen(files.select_files(table, "XX")) == []
    assert len(chosen(files.select_files(table, "ST"))) == 5


def test_latest_file_is_no_template(spark):
    table = spark.createDataFrame([(n[:2].upper(), n) for n in NAMES], "grupo string, name string")
    found = {r.grupo: r.name for r in files.latest_files(table, "grupo").collect()}
    assert found == {"ST": "stRJ2601.dbc", "EP": "EPSP2601.dbc"}
    assert files.latest_files(table.limit(0), "grupo").count() == 0


def test_list_files(spark, tmp_path):
    for name in ("STSP2601.dbc", "a.txt"):
        (tmp_path / name).write_text("x")
    found = files.list_files(spark, str(tmp_path), "*.dbc")
    assert chosen(found) == ["STSP2601.dbc"]
    assert "content" not in found.columns


def test_read_tables(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("a", "b")]
    for i, path in enumerate(paths):
        spark.range(i * 3, i * 3 + 3).withColumn("v", F.lit(i)).coalesce(1).write.parquet(path)
    assert tables.column_names(spark, *paths) == ["id", "v"]
    assert tables.count_rows(spark, *paths) == 6
    assert tables.read_table(spark, *paths, columns=["id"]).columns == ["id"]
    ordered = tables.read_table_in_order(spark, *paths).where("v = 1").orderBy("ord")
    assert [r.id for r in ordered.collect()] == [3, 4, 5]
    assert dict(ordered.dtypes)["ord"] == "bigint"


def test_text_csv(spark, tmp_path):
    path = str(tmp_path / "cache")
    absent = tables.read_text_csv(spark, path, ["a", "b"], ordinal="pos")
    assert absent.count() == 0 and absent.columns == ["a", "b", "pos"]
    df = spark.createDataFrame([("007", " x "), ("008", None)], "a string, c string")
    sinks.write_csv(df, path)
    found = tables.read_text_csv(spark, path, ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in found] == [("007", None, " x "), ("008", None, None)]


def test_text_csv_positions_follow_the_file(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("k\n" + "\n".join(f"v{i}" for i in range(50)) + "\n")
    found = tables.read_text_csv(spark, str(path), ["k"], ordinal="pos").orderBy("pos").collect()
    assert [r.k for r in found] == [f"v{i}" for i in range(50)]


def test_early_failures(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.require_paths(spark, str(tmp_path / "none"))
    tables.require_paths(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no rows"):
        tables.require_rows(spark.range(0), "cases")


def test_write_csv_first_rows(spark, tmp_path):
    path = tmp_path / "top"
    sinks.write_csv(spark.range(10), str(path), [F.desc("id")], n=3)
    parts = [p for p in path.iterdir() if p.suffix == ".csv"]
    assert [p.read_text() for p in parts] == ["id\n9\n8\n7\n"]


def test_write_table_sorts_with_nulls_last(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "k string")
    sinks.write_table(df, path, sort_by=["k"], compression="zstd")
    assert [r.k for r in spark.read.parquet(path).collect()] == ["a", "b", None]
    sinks.write_table(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_write_table_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2026, "SP", 1), (2025, "TO", 2)], "year int, state string, v int")
    sinks.write_table(df, path, partition_by=["year", "state"])
    found = spark.read.parquet(path).where("year = 2026")
    assert [r.v for r in found.collect()] == [1]
    assert "PartitionFilters: [isnotnull(year" in found._jdf.queryExecution().executedPlan().toString()


def test_metrics_and_json(spark, tmp_path):
    df = spark.createDataFrame([("s", 1)], "section string, n long")
    for kind in ("csv", "json"):
        sinks.write_metrics(df, str(tmp_path / kind), kind)
    assert spark.read.json(str(tmp_path / "json")).collect() == spark.read.schema(
        "section string, n long"
    ).option("header", True).csv(str(tmp_path / "csv")).select("n", "section").collect()
    entry = spark.createDataFrame([("A", {"1": "Sim"})], "name string, fatores map<string,string>")
    sinks.write_json(entry, str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in (tmp_path / "doc").iterdir() if p.suffix == ".json")
    assert json.loads(text) == {"name": "A", "fatores": {"1": "Sim"}}


def test_payload(spark):
    df = spark.createDataFrame(
        [('[{"id":1100015,"nome":"Alta Floresta"},{"id":53,"nome":null,"x":1}]',), ("[]",)],
        "payload string",
    )
    found = payload.official_municipalities(df).collect()
    assert [tuple(r) for r in found] == [("1100015", "Alta Floresta"), ("53", None)]


DOCUMENT = {
    "external_lookup_variables": ["ID_AGRAVO", "SG_UF"],
    "variables": {
        "TP_NOT": {"group": "g", "label": "Tipo", "domain_type": "closed", "values": {1: "a", "2": "b"}},
        "DT_NOTIFIC": {"group": "g", "label": "Data", "domain_type": "date"},
    },
}


@pytest.mark.parametrize("kind", ["json", "yaml"])
def test_dictionary(spark, tmp_path, kind):
    path = tmp_path / f"d.{kind}"
    if kind == "yaml":
        path.write_text(pytest.importorskip("yaml").safe_dump(DOCUMENT), encoding="utf-8")
    else:
        path.write_text(json.dumps(DOCUMENT), encoding="utf-8")
    document = dictionary.read_document(spark, str(path))
    rows = {r.name: r for r in dictionary.variable_table(spark, document).collect()}
    assert rows["TP_NOT"]["values"] == {"1": "a", "2": "b"}
    assert rows["DT_NOTIFIC"]["values"] is None and rows["DT_NOTIFIC"].domain_type == "date"
    names = {r.name for r in dictionary.declared_names(spark, document).collect()}
    assert names == {"ID_AGRAVO", "SG_UF", "TP_NOT", "DT_NOTIFIC"}


def test_consolidated_cases(spark, tmp_path):
    years = [spark.createDataFrame([(f"{y}", y)], "k string, y int") for y in (2007, 2008)]
    assert case_plans.write_cases(years, str(tmp_path / "cases")) == 2


def test_shared_folder_setting_wins(spark, monkeypatch):
    assert shared_folder(spark) == shared_folder(spark)

    class Conf:
        def get(self, name, default=None):
            return "/shared/work/" if name == "spark.checkpoint.dir" else default

    class Cluster:
        conf = Conf()

    assert shared_folder(Cluster()) == "/shared/work"

    class Bare:
        class conf:
            @staticmethod
            def get(name, default=None):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Bare())


def test_columns_of_later_files_are_kept(spark, tmp_path):
    spark.createDataFrame([("a", "1")], "CNES string, TP_UNID string").write.parquet(f"{tmp_path}/x1")
    spark.createDataFrame([("b", "9")], "CNES string, COD_CEP string").write.parquet(f"{tmp_path}/x2")
    table = tables.read_table_in_order(spark, f"{tmp_path}/x1", f"{tmp_path}/x2")
    rows = sorted(tuple(r) for r in table.select("CNES", "TP_UNID", "COD_CEP").collect())
    assert rows == [("a", "1", None), ("b", None, "9")]
    spark.createDataFrame([(1, "9")], "CNES int, COD_CEP string").write.parquet(f"{tmp_path}/x3")
    with pytest.raises(Exception, match="(?i)merg"):
        tables.read_aligned(spark, f"{tmp_path}/x1", f"{tmp_path}/x3")


def test_latest_files_leave_templates_out(spark, tmp_path):
    import pandas as pd

    for name, year in (("STSP2512", 25), ("STSP2601", 26), ("STufAAmm", 0), ("EPSP2401", 24)):
        pd.DataFrame({"COD_CEP": [str(year)], "N": [year]}).to_parquet(f"{tmp_path}/{name}.parquet")
    found = files.latest_paths(spark, str(tmp_path), ["ST", "EP", "PF"])
    assert {g: p.rsplit("/", 1)[-1] for g, p in found.items()} == {
        "ST": "STSP2601.parquet",
        "EP": "EPSP2401.parquet",
    }
    paths = files.find_inputs(spark, str(tmp_path), "ST", ".parquet", 2026, 1)
    assert [p.rsplit("/", 1)[-1] for p in paths] == ["STSP2601.parquet"]
    facts, _ = inspection.inspect_latest(spark, str(tmp_path), ["N"], "ST")
    assert facts.first().file == "STSP2601.parquet"
    scan = inspection.scan_folder(spark, str(tmp_path), ["ST", "EP", "PF"])
    assert sorted((r.grupo, r.coluna, r.primeiro) for r in scan.collect()) == [
        ("EP", "COD_CEP", "24"),
        ("PF", None, None),
        ("ST", "COD_CEP", "26"),
    ]


def test_footers_of_files_and_of_folders_of_parts(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"b": ["x", None], "a": [1, 2]}).to_parquet(f"{tmp_path}/one.parquet")
    pd.DataFrame({"b": pd.Series([], dtype="str"), "a": pd.Series([], dtype="int64")}).to_parquet(f"{tmp_path}/none.parquet")
    pd.DataFrame().to_parquet(f"{tmp_path}/bare.parquet")
    rows = spark.createDataFrame([(i, f"v{i}", True) for i in range(9)], "id long, t string, f boolean")
    rows.repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(f"{tmp_path}/key=parts.parquet")
    found = footers.footers(footers.list_parts(spark, str(tmp_path), pattern="*.parquet"))
    facts = {r.file: (r.n_rows, r.n_columns, r.columns) for r in footers.table_facts(found).collect()}
    assert facts == {
        "one.parquet": (2, 2, "b,a"),
        "none.parquet": (0, 2, "b,a"),
        "bare.parquet": (0, 0, ""),
        "parts.parquet": (9, 3, "id,t,f"),
    }
    columns = {(r.name, r.column): (r.type, r.first) for r in footers.table_columns(found).collect()}
    assert columns["one.parquet", "b"] == ("string", "x") and columns["one.parquet", "a"] == ("int64", "1")
    assert columns["none.parquet", "a"] == ("int64", None)
    assert [columns["parts.parquet", c][1] for c in ("id", "t", "f")] == ["0", "v0", "true"]


def test_files_that_differ_are_named(spark, tmp_path):
    import pandas as pd

    for i in range(40):
        pd.DataFrame({"a": [i], "b": ["x"]}).to_parquet(f"{tmp_path}/f{i}.parquet")
    same = footers.list_parts(spark, str(tmp_path), pattern="*.parquet")
    footers.require_same_columns(footers.footers(same))
    pd.DataFrame({"b": ["x"], "a": [1.5]}).to_parquet(f"{tmp_path}/g.parquet")
    with pytest.raises(ValueError, match=r"g\.parquet.*\['a'\]"):
        footers.require_same_columns(footers.footers(footers.list_parts(spark, str(tmp_path), pattern="*.parquet")))
    with pytest.raises(Exception, match="two types"):
        both = footers.footers(same).withColumn("path", F.lit("p"))
        footers.table_columns(both.union(both.withColumn("type", F.lit("int8")))).collect()


PAYLOADS = [
    ('[{"id":1,"nome":"a"},{"id":2,"nome":null}]', 0),
    ('[{"id":3,"nome":"c"},{"id":4,', 1),
    ("  ", 2),
    (None, 3),
    ('[{"nome":"x"}]', 4),
    ('{"id"', 5),
    ("[]", 6),
]


def test_bad_payloads_are_an_error_or_set_aside(spark):
    df = spark.createDataFrame(PAYLOADS, "payload string, place int")
    with pytest.raises(Exception, match="bad payload: no JSON array"):
        payload.official_municipalities(spark.createDataFrame(PAYLOADS[:2], "payload string, place int")).collect()
    good, bad = payload.split_payloads(df)
    assert sorted(r[0] for r in good.collect()) == ["1", "2"]
    assert {r.place: r.fault for r in bad.collect()} == {
        1: payload.NOT_A_LIST,
        2: payload.NO_PAYLOAD,
        3: payload.NO_PAYLOAD,
        4: payload.NO_ID,
        5: payload.NOT_A_LIST,
    }
    assert {r.fault: r.n for r in payload.fault_counts(bad).collect()}[payload.NO_PAYLOAD] == 2


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2\n3\n4,5,6\n,\n")
    good, bad = tables.split_text_csv(spark, str(tmp_path / "c.csv"), ["b", "a", "z"])
    assert sorted((tuple(r) for r in good.collect()), key=str) == [("2", "1", None), (None, None, None)]
    assert sorted(r.line for r in bad.collect()) == ["3", "4,5,6"]


def test_counts_of_the_writing_pass(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 3 as k").repartition(7)
    aggregates = [F.count_if(F.col("k") == 1).alias("ones"), F.count("*").alias("n"), F.max("id").alias("top")]
    for sort_by in ((), ["id"]):
        row = sinks.write_observed(df, str(tmp_path / "t"), aggregates, sort_by).first()
        assert tuple(row) == (333, 1000, 999)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_results_that_come_in_as_files(spark, tmp_path, monkeypatch):
    """A run that is killed within a batch and taken up again loses and repeats nothing."""
    incoming, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    results = spark.range(60).selectExpr("cast(id % 50 as string) as cep_limpo", "id as seq")
    results.repartition(6, "seq").write.parquet(incoming)
    saved, save = [], cache_plans.save_batch

    def killed(df, path, batch):
        if len(saved) == 2:
            # Half of the batch is there when the run dies.
            save(df.limit(1), path, batch)
            raise RuntimeError("killed")
        save(df, path, batch)
        saved.append(batch)

    monkeypatch.setattr(cache_plans, "save_batch", killed)
    with pytest.raises(Exception, match="killed"):
        cache_plans.take_in_results(spark, incoming, results.schema, out, checkpoint, files_per_batch=1)
    monkeypatch.setattr(cache_plans, "save_batch", save)
    for _ in range(2):
        cache_plans.take_in_results(spark, incoming, results.schema, out, checkpoint, files_per_batch=1)
        assert sorted(r.seq for r in cache_plans.saved_results(spark, out).collect()) == list(range(60))
    spark.createDataFrame([("0", 99)], results.schema).write.mode("append").parquet(incoming)
    cache_plans.take_in_results(spark, incoming, results.schema, out, checkpoint)
    assert {r.cep_limpo: r.seq for r in cache_plans.read_results(spark, out, ["seq"]).collect()}["0"] == 99
