"""Looking into tables and files before they are used."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolink.functions.keys import has_period
from geolink.operators.ranking import top_n
from geolink.plans.territory import count_by_state
from geolink.sources import footers
from geolink.sources.files import latest_of_groups, latest_paths

# Parts of column names that hint at an address or a name.
ADDRESS_PATTERNS = ("CEP", "LOGRA", "ENDERE", "BAIR", "NUM", "COMPL", "FANT", "RAZA", "NOME")


def name_contains(name, patterns: Sequence[str] = ADDRESS_PATTERNS):
    """True where the name, whatever its case, contains any of the patterns."""
    return F.upper(F.col(name)).rlike("|".join(re.escape(p) for p in patterns))


def scan_inventory(
    inventory: DataFrame,
    patterns: Sequence[str] = ADDRESS_PATTERNS,
    group: str = "grupo",
    file: str = "arquivo",
    column: str = "coluna",
    value: str = "primeiro",
) -> DataFrame:
    """Scan an inventory of file columns, one row per (group, file, column) with a first value.

    Per group the file with the greatest name is taken, template names aside. The result has one
    row per matching column, with the column count of its file; a group without a match has one
    row with a null column. The inventory is counted per file first, so the choice of the file
    handles one row per file. The matching columns are then inner joined with the chosen files, so
    that either side may be broadcast or split, which a left join from the files would not allow.
    """
    dated = inventory.where(has_period(file))
    files = dated.groupBy(group, file).agg(
        F.count("*").alias("n_colunas"),
        F.count_if(name_contains(column, patterns)).alias("_matches"),
    )
    latest = (
        files.groupBy(group)
        .agg(F.max_by(F.struct(file, "n_colunas", "_matches"), file).alias("f"))
        .select(group, "f.*")
    )
    matches = dated.where(name_contains(column, patterns)).select(group, file, column, value)
    found = matches.join(latest.drop("_matches"), [group, file])
    without = latest.where("_matches = 0").select(
        group,
        file,
        "n_colunas",
        F.lit(None).cast("string").alias(column),
        F.lit(None).cast("string").alias(value),
    )
    return found.select(*without.columns).unionAll(without)


def _scanned(chosen: DataFrame, found: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Groups with their file's column count, matching columns and first values.

    ``chosen`` is ``(group, path, name)``, a row for each group; what is absent is null. A file is
    known by its footer, so one without rows has its columns too.
    """
    columns = footers.table_columns(found)
    wanted = F.col("column").isNotNull() & name_contains("column", patterns)
    counts = columns.groupBy("path").agg(F.max("n_columns").alias("n_colunas"))
    matches = columns.where(wanted).select(
        "path", F.col("column").alias("coluna"), F.col("first").alias("primeiro")
    )
    return (
        chosen.join(counts, "path", "left")
        .join(matches, "path", "left")
        .select(F.col("group").alias("grupo"), F.col("name").alias("arquivo"), "n_colunas", "coluna", "primeiro")
    )


def scan_groups(
    spark: SparkSession,
    chosen: Mapping[str, str],
    patterns: Sequence[str] = ADDRESS_PATTERNS,
) -> DataFrame:
    """Scan the given file of each group: column count, matching columns and their first values."""
    parts = footers.list_parts(spark, *chosen.values(), pattern="*.parquet")
    # The listing writes paths in full; the given ones may lack the scheme.
    short = F.regexp_replace("path", "^file:/+", "/")
    rows = [(g, re.sub("^file:/+", "/", p.rstrip("/"))) for g, p in chosen.items()]
    wanted = spark.createDataFrame(rows, "group string, path string")
    named = wanted.withColumn("name", F.regexp_extract("path", "([^/=]+)$", 1))
    return _scanned(named, footers.footers(parts.withColumn("path", short)), patterns)


def scan_folder(
    spark: SparkSession,
    folder: str,
    groups: Sequence[str],
    suffix: str = ".parquet",
    patterns: Sequence[str] = ADDRESS_PATTERNS,
) -> DataFrame:
    """Scan the latest file of each group in a folder, templates aside.

    A group without a file, without rows in it, or without a matching column keeps one row. Listing,
    choice and footers are jobs; the driver reads no file.
    """
    parts = footers.list_parts(spark, folder, pattern=f"*{suffix}")
    chosen = latest_of_groups(parts.select("path", "name").distinct(), groups, suffix)
    found = footers.footers(parts.join(chosen.select("path"), "path", "left_semi"))
    return _scanned(chosen, found, patterns)


def file_facts(table: DataFrame, label: str) -> DataFrame:
    """Row count and column names of one table: ``(file, n_rows, n_columns, columns)``."""
    return table.agg(F.count("*").alias("n_rows")).select(
        F.lit(label).alias("file"),
        "n_rows",
        F.lit(len(table.columns)).cast("long").alias("n_columns"),
        F.lit(",".join(table.columns)).alias("columns"),
    )


def first_rows(table: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """The first rows of a table in a given order."""
    return top_n(table, n, ascending=list(order))


def inspect_latest(
    spark: SparkSession, folder: str, order: Sequence[str], prefix: str = "", suffix: str = ".parquet"
) -> tuple[DataFrame, DataFrame]:
    """Facts and first rows of the latest Parquet file in a folder, monthly or yearly.

    Templates do not count. The facts come from the footers.
    """
    found = latest_paths(spark, folder, [prefix], suffix, digits=2)
    if not found:
        raise FileNotFoundError(f"no file {prefix}*{suffix} with a period in {folder}")
    path = found[prefix]
    parts = footers.list_parts(spark, path, pattern="*.parquet")
    facts = footers.table_facts(footers.footers(parts)).drop("path")
    return facts, first_rows(spark.read.parquet(path), order)


def inspect_groups(
    spark: SparkSession, folder: str, groups: Sequence[str], suffix: str = ".parquet"
) -> DataFrame:
    """Row count and column names of the latest file of each group, from the footers."""
    parts = footers.list_parts(spark, folder, pattern=f"*{suffix}")
    chosen = latest_of_groups(parts.select("path", "name").distinct(), groups, suffix)
    found = footers.footers(parts.join(chosen.select("path"), "path", "left_semi"))
    facts = footers.table_facts(found)
    return chosen.drop("name").join(facts, "path", "left").drop("path")


def territory_facts(territory: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Row count, rows per state in state order, and the first rows by municipality code."""
    total = territory.agg(F.count("*").alias("n"))
    per_state = count_by_state(territory).orderBy(F.col("uf_sigla").asc_nulls_last())
    return total, per_state, top_n(territory, n, ascending=["municipio_codigo_7"])
