"""Input tables derived from the test tables, for the registered queries and the benchmark.

The rules follow ``FIXTURES.md``: every table here is a projection or key join of given tables, so
its size grows with them. No row is left out: where a key is to be missing, the row gets a key that
nothing else has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_tables: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    # The same lazy scan serves all uses, so that its footer is read once per session.
    key = (spark.sparkContext.applicationId, path)
    if key not in _tables:
        _tables[key] = spark.read.parquet(path)
    return _tables[key]


def places(spark: SparkSession, d: str) -> DataFrame:
    """Territory lookup: one row per nation."""
    joined = table(spark, d, "nation").join(
        table(spark, d, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return joined.selectExpr(
        "*",
        "concat(cast(r_regionkey + 11 as string),"
        " lpad(cast(1000 + n_nationkey * 10 + n_nationkey % 10 as string), 5, '0')) as code7",
    ).selectExpr(
        "code7 as municipio_codigo_7",
        "substr(code7, 1, 6) as municipio_codigo_6",
        "n_name as municipio_nome",
        "substr(code7, 1, 2) as uf_codigo",
        "concat('U', cast(r_regionkey as string)) as uf_sigla",
        "r_name as uf_nome",
        "-70d + 1.5d * n_nationkey as centroide_lon",
        "-30d + 1.25d * n_nationkey as centroide_lat",
        "100d * (n_nationkey + 1) as area_km2",
        "n_nationkey",
    )


def territory(spark: SparkSession, d: str) -> DataFrame:
    return places(spark, d).drop("n_nationkey")


def customers(spark: SparkSession, d: str) -> DataFrame:
    """Customers with the place of their nation."""
    return table(spark, d, "customer").join(
        places(spark, d), F.expr("c_nationkey = n_nationkey")
    )


def cases(spark: SparkSession, d: str) -> DataFrame:
    """Case records: one row per order."""
    home = customers(spark, d).selectExpr(
        "c_custkey", "municipio_codigo_6 as r_mun", "uf_codigo as r_uf"
    )
    seen = places(spark, d).selectExpr(
        "n_nationkey as seen_key", "municipio_codigo_6 as n_mun", "uf_codigo as n_uf"
    )
    return (
        table(spark, d, "orders")
        .join(home, F.expr("o_custkey = c_custkey"))
        .join(seen, F.expr("o_orderkey % 25 = seen_key"))
        .selectExpr(
            "o_orderkey as case_id",
            "if(o_orderkey % 97 = 0, concat(r_uf, '0000'), r_mun) as ID_MN_RESI",
            "n_mun as ID_MUNICIP",
            "case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then '  '"
            " when o_orderkey % 11 = 0 then substr(r_mun, 1, 4) else r_mun end as ATE_MUNICI",
            "if(o_orderkey % 13 = 0, '99', r_uf) as SG_UF",
            "n_uf as SG_UF_NOT",
            "if(o_orderkey % 3 = 0, r_uf, '9') as ATE_UF_HOS",
            "case when o_orderkey % 101 = 0 then null"
            " when o_orderkey % 2 = 0 then concat(' ', lpad(cast(o_custkey as string), 7, '0'), ' ')"
            " else lpad(cast(o_custkey as string), 7, '0') end as ID_UNIDADE",
        )
    )


def registry(spark: SparkSession, d: str) -> DataFrame:
    """Facility register: three rows per customer; one customer in seven has a key of no case.

    The third rows all are of one facility. Some codes are good for a state only, some for nothing.
    """
    return (
        customers(spark, d)
        .selectExpr("*", "explode(array(1, 2, 3)) as part_no")
        .selectExpr(
            "case when part_no = 3 then '0000001'"
            " when c_custkey % 7 = 0 then concat('X', cast(c_custkey as string))"
            " else lpad(cast(c_custkey as string), 7, '0') end as CNES",
            "case when c_custkey % 37 = 0 then uf_codigo when c_custkey % 41 = 0 then '0'"
            " when part_no = 1 and c_custkey % 4 = 0 then ' '"
            " when c_custkey % 53 = 0 then '000000'"
            " when c_custkey % 31 = 0 then concat(uf_codigo, '9999')"
            " else municipio_codigo_6 end as CODUFMUN",
            "case when c_custkey % 37 = 0 or c_custkey % 41 = 0 then '0'"
            " when part_no = 1 and c_custkey % 3 = 0 then null"
            " when part_no = 1 and c_custkey % 5 = 0 then '\t'"
            " when c_custkey % 29 = 0 then '00000000'"
            " else concat(lpad(cast(10000 + c_custkey % 700 as string), 5, '0'), '-',"
            " lpad(cast(c_custkey % 2 as string), 3, '0')) end as COD_CEP",
            "if(part_no = 3, '01', lpad(cast(c_custkey % 20 as string), 2, '0')) as TP_UNID",
            "if(part_no = 1, null, substr('MED', cast(c_custkey % 3 + 1 as int), 1)) as TPGESTAO",
            "lpad(cast(c_custkey % 4 + 1 as string), 2, '0') as ESFERA_A",
            "c_mktsegment as NAT_JUR",
            "if(part_no = 1 and c_custkey % 6 = 0, ' ', '202601') as COMPETEN",
            "c_custkey * 10 + part_no as ord",
        )
    )


def cache(spark: SparkSession, d: str) -> DataFrame:
    """Geocode cache: repeated, failed and unused keys, and one point that a third shares.

    One postal code in nine is not cached, however many facilities have it.
    """
    return (
        customers(spark, d)
        .selectExpr(
            "if(c_custkey % 700 % 9 = 0, concat('X', cast(c_custkey as string)),"
            " concat(lpad(cast(10000 + c_custkey % 700 as string), 5, '0'),"
            " lpad(cast(c_custkey % 2 as string), 3, '0'))) as cep_limpo",
            "case when c_custkey % 10 = 0 then null when c_custkey % 3 = 0 then -15.803258d"
            " else centroide_lat + 0.03d * (c_custkey % 50 - 25) end as latitude",
            "case when c_custkey % 10 = 0 then null when c_custkey % 3 = 0 then -47.885477d"
            " else centroide_lon end as longitude",
            "if(c_custkey % 10 = 0, 'False', 'True') as geocode_success",
            "c_custkey as seq",
        )
    )


def new_results(spark: SparkSession, d: str) -> DataFrame:
    """New geocode results, from suppliers: some repeat cached keys, some repeat each other."""
    return table(spark, d, "supplier").selectExpr(
        "concat(lpad(cast(10600 + s_suppkey % 300 as string), 5, '0'),"
        " lpad(cast(s_suppkey % 2 as string), 3, '0')) as cep_limpo",
        "if(s_suppkey % 4 <> 0, -10d - 0.5d * s_nationkey, null) as latitude",
        "if(s_suppkey % 4 <> 0, -50d + 0.5d * s_nationkey, null) as longitude",
        "s_suppkey % 4 <> 0 as geocode_success",
        "s_suppkey as seq",
    )


def coordinate_registry(spark: SparkSession, d: str) -> DataFrame:
    """A register that has names and coordinates under varying column names."""
    return (
        table(spark, d, "supplier")
        .selectExpr("*", "explode(array(1, 2, 3)) as part_no")
        .selectExpr(
            "if(s_suppkey % 17 = 0, '  ', concat(lpad(cast(s_suppkey as string), 7, '0'), ' '))"
            " as co_cnes",
            "concat(' ', s_name, '/', cast(part_no as string)) as NO_FANTASIA",
            "if(s_suppkey % 6 = 0, 'n/d', concat(' -1', cast(s_suppkey % 10 as string), '.',"
            " cast(part_no as string), ' ')) as nu_latitude",
            "if(s_suppkey % 5 = 0, null, concat('-4', cast(s_suppkey % 10 as string), '.',"
            " cast(s_nationkey as string))) as NU_LONGITUDE",
            "s_suppkey * 10 + part_no as ord",
        )
    )


# Seven digits at any size: beyond a hundred thousand, customers of a state share municipalities.
MESH_CODE = "concat(uf_codigo, lpad(cast(c_custkey % 100000 as string), 5, '0'))"


def mesh(spark: SparkSession, d: str) -> DataFrame:
    """Mesh attributes: a municipality per customer or more, some with codes that are no codes."""
    parts = customers(spark, d).selectExpr(
        f"concat({MESH_CODE}, if(c_custkey % 17 = 0, 'X', '')) as cd_mun",
        "concat('M', cast(c_custkey as string)) as NM_MUN",
        "if(c_custkey % 6 <> 0, concat('S', uf_codigo), null) as SIGLA_UF",
        "0.5d * c_custkey as AREA_KM2",
        "c_custkey",
    )
    return parts.groupBy("cd_mun").agg(
        *[F.min_by(c, "c_custkey").alias(c) for c in ("NM_MUN", "SIGLA_UF")],
        F.max("AREA_KM2").alias("AREA_KM2"),
    )


def mesh_vertices(spark: SparkSession, d: str) -> DataFrame:
    """Pentagons in degrees per customer of a municipality; one in five has a triangular hole.

    Half of the holes run the same way round as their shells.

    The vertices are numbered with gaps, most of them larger than a piece of a ring.
    """
    shell = [(0, 0), (40, 0), (50, 30), (20, 45), (-10, 25)]
    hole = [(10, 10), (10, 20), (20, 10)]

    def ring(number: int, points) -> str:
        def place(i: int) -> str:
            return f"if({number} = 1 and c_custkey % 10 = 0, {len(points) - 1 - i}, {i})"

        return ", ".join(
            f"named_struct('ring', c_custkey div 100000 * 2 + {number},"
            f" 'seq', {place(i)} * (c_custkey % 7) * 9001 + {place(i)},"
            f" 'x', -70d + 0.03d * (c_custkey % 1000) + 0.0002d * {dx},"
            f" 'y', -30d + 0.1d * (c_custkey % 300) + 0.0002d * {dy})"
            for i, (dx, dy) in enumerate(points)
        )

    plain, holed = f"array({ring(0, shell)})", f"array({ring(0, shell)}, {ring(1, hole)})"
    return customers(spark, d).selectExpr(
        f"concat({MESH_CODE}, if(c_custkey % 17 = 0, 'X', '')) as poly",
        f"inline(if(c_custkey % 5 = 0, {holed}, {plain}))",
    )


def official_payloads(spark: SparkSession, d: str) -> DataFrame:
    """JSON arrays of two official municipalities; the second, and at times the first, has no mesh."""
    name = "if(c_custkey % 10 = 1, 'null', concat('\"N', cast(c_custkey as string), '\"'))"
    return (
        customers(spark, d)
        .selectExpr(
            f"""concat('[{{"id":', if(c_custkey % 8 = 0 or c_custkey >= 100000, concat('98', cast(c_custkey as string)),
                {MESH_CODE}), ',"nome":', {name}, '}},{{"id":99',
                cast(c_custkey as string), ',"nome":"fora"}}]') as payload"""
        )
    )


def event_payloads(spark: SparkSession, d: str) -> DataFrame:
    """JSON arrays built from the properties of events."""
    return table(spark, d, "events").selectExpr(
        """concat('[{"id":', regexp_extract(props, '([0-9]+)', 1), ',"nome":"', event_type,
            '"},{"id":', cast(event_id as string), ',"nome":null}]') as payload""",
        "event_id",
    )


def file_names(spark: SparkSession, d: str) -> DataFrame:
    """File names with group, state and period, from orders; a few are templates."""
    return (
        table(spark, d, "orders")
        .selectExpr(
            "*", "element_at(array('ST', 'st', 'EP', 'DC'), cast(o_orderkey % 4 + 1 as int)) as g"
        )
        .selectExpr(
            "upper(g) as grupo",
            "if(o_orderkey % 1000 >= 996, concat(g, 'ufAAmm.dbc'),"
            " concat(g, 'U', cast(o_custkey % 10 as string),"
            " lpad(cast(year(o_orderdate) % 100 as string), 2, '0'),"
            " lpad(cast(month(o_orderdate) as string), 2, '0'),"
            " element_at(array('.dbc', '.DBC', '.dbf'), cast(o_orderkey % 3 + 1 as int)))) as name",
        )
    )


def named_tables(spark: SparkSession, d: str, out: str) -> None:
    """Writes orders as many tables named by group, state and period, one empty and one a template.

    The groups have columns of their own. The rows of a table are in order over its parts.
    """
    orders = table(spark, d, "orders")
    period = "lpad(cast(year(o_orderdate) % 100 as string), 2, '0'), if(o_custkey % 2 = 0, '06', '12')"
    columns = {
        "ST": ["lpad(cast(o_custkey as string), 7, '0') as CNES", "o_orderpriority as COD_CEP", "o_orderkey as NU_ORDEM"],
        "EP": ["o_orderstatus as NOME_FANT", "o_orderkey as NUM_ORDEM"],
        "DC": ["o_orderkey as NU_ORDEM", "o_totalprice as VALOR"],
    }
    for i, (group, of_group) in enumerate(columns.items()):
        rows = orders.where(f"o_orderkey % 3 = {i}").selectExpr(
            "o_orderkey as _key", f"concat('{group}SP', {period}, '.parquet') as file", *of_group
        )
        ordered = rows.repartitionByRange("file", "_key").sortWithinPartitions("file", "_key").drop("_key")
        ordered.write.mode("append").partitionBy("file").parquet(out)
    orders.where("o_orderkey % 97 = 0").orderBy("o_orderkey").selectExpr(*columns["ST"]).write.parquet(
        f"{out}/file=STufAAmm.parquet"
    )
    orders.where("false").selectExpr(*columns["EP"]).write.parquet(f"{out}/file=EPSP9999.parquet")


def broken_payloads(spark: SparkSession, d: str) -> DataFrame:
    """The payloads of events, some cut short, some without an id or not there."""
    return event_payloads(spark, d).selectExpr(
        "case event_id % 11 when 3 then substr(payload, 1, length(payload) - 4) when 5 then '  '"
        " when 7 then replace(payload, '\"id\"', '\"code\"') when 9 then null else payload end as payload"
    )


def broken_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a CSV of suppliers without its header; some have a column too many or too few."""
    return table(spark, d, "supplier").selectExpr(
        "concat_ws(',', lpad(cast(s_suppkey as string), 8, '0'), if(s_suppkey % 9 = 2, null, cast(s_nationkey as string)),"
        " 'True', if(s_suppkey % 13 = 5, 'more', null)) as value"
    )


def column_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Columns of files, from line items: (group, file, column) with a first value."""
    return (
        table(spark, d, "lineitem")
        .selectExpr(
            "element_at(array('DC', 'EP', 'PF', 'ST'), cast(l_suppkey % 4 + 1 as int)) as grupo",
            "if(l_orderkey % 1000 = 999, 'ufAAmm.dbc', concat('SP',"
            " lpad(cast(l_partkey % 20 as string), 2, '0'),"
            " lpad(cast(l_partkey % 12 + 1 as string), 2, '0'), '.dbc')) as tail",
            "l_linenumber % 7 as line",
            "cast(l_orderkey % 60 as string) as number",
            "l_orderkey",
        )
        .selectExpr(
            "grupo",
            "concat(grupo, tail) as arquivo",
            "case line when 0 then 'COD_CEP' when 1 then concat('S_RECEPC', number)"
            " when 2 then concat('num_', number) when 3 then concat('NOME_', number)"
            " else concat('QT_', number) end as coluna",
            "l_orderkey",
        )
        .groupBy("grupo", "arquivo", "coluna")
        .agg(F.min("l_orderkey").cast("string").alias("primeiro"))
    )


def declared_columns(spark: SparkSession, d: str) -> DataFrame:
    """Declared column names, from parts."""
    return (
        table(spark, d, "part")
        .selectExpr(
            "case p_partkey % 3 when 0 then concat('QT_', cast(p_partkey % 50 as string))"
            " when 1 then concat('NOME_', cast(p_partkey % 70 as string))"
            " else concat('DT_', cast(p_size as string)) end as name"
        )
        .distinct()
    )


def dictionary_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of document tables, from parts: most have four cells, some one or three."""
    return (
        table(spark, d, "part")
        .selectExpr(
            "p_partkey",
            "concat(' ', p_type, '_', cast(p_size as string), ' ') as name",
            "if(p_partkey % 13 = 0, null, concat(' ', p_name, ' ')) as label",
            "concat('1 - Sim 2 – Não 9-', p_name, '\\n1 - ', p_brand) as codes",
        )
        .selectExpr(
            "p_partkey div 40 as page",
            "p_partkey % 40 as row",
            "case p_partkey % 7 when 0 then array(name) when 1 then array('campo', label, name)"
            " else array('campo', label, name, codes) end as cells",
        )
    )
