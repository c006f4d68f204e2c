"""The variable dictionary: audits against a table, and extraction from table cells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolink.functions.keys import code_label_map, is_variable_name, or_empty, stripped
from geolink.operators.dedupe import keep_last
from geolink.operators.metrics import count_metric, metrics_long
from geolink.operators.stacking import compare_names
from geolink.sources.dictionary import declared_names

# Fixed value: label of a variable whose table row has no second cell.
NO_LABEL = "Label não capturado"


def name_table(spark: SparkSession, names) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name string")


def audit_names(observed: DataFrame, declared: DataFrame, name: str = "name") -> DataFrame:
    """Counts of names seen, declared, in both and on one side only."""
    sides = compare_names(observed, declared, name).agg(
        F.count_if("in_observed").alias("o"),
        F.count_if("in_declared").alias("d"),
        F.count_if(F.col("in_observed") & F.col("in_declared")).alias("both"),
        F.count_if(~F.col("in_declared")).alias("o_only"),
        F.count_if(~F.col("in_observed")).alias("d_only"),
    )
    section = "schema"
    return metrics_long(
        sides,
        [
            count_metric(section, "observed", F.col("o")),
            count_metric(section, "declared", F.col("d")),
            count_metric(section, "in_both", F.col("both")),
            count_metric(section, "observed_only", F.col("o_only")),
            count_metric(section, "declared_only", F.col("d_only")),
        ],
    )


def one_sided_names(observed: DataFrame, declared: DataFrame, name: str = "name") -> DataFrame:
    """The names that only one side has, with that side."""
    sides = compare_names(observed, declared, name).where(
        F.col("in_observed") != F.col("in_declared")
    )
    side = F.when(F.col("in_observed"), "observed_only").otherwise("declared_only")
    return sides.select(side.alias("side"), name)


def audit_table_schema(table: DataFrame, document: Mapping) -> tuple[DataFrame, DataFrame]:
    """Counts and one-sided names of a table's columns against a dictionary document."""
    spark = table.sparkSession
    observed, declared = name_table(spark, table.columns), declared_names(spark, document)
    return audit_names(observed, declared), one_sided_names(observed, declared)


def load_summary(table: DataFrame, n_described: int = 0, n_external: int = 0) -> DataFrame:
    """Rows and columns of a table next to the sizes of its dictionary."""
    section = "load"
    return metrics_long(
        table.agg(F.count("*").alias("rows")),
        [
            count_metric(section, "rows", F.col("rows")),
            count_metric(section, "columns", F.lit(len(table.columns))),
            count_metric(section, "described_variables", F.lit(n_described)),
            count_metric(section, "external_variables", F.lit(n_external)),
        ],
    )


def dictionary_from_cells(
    rows: DataFrame, cells: str = "cells", page: str = "page", row: str = "row"
) -> DataFrame:
    """Variables ``(name, label, fatores, pagina)`` found in the rows of document tables.

    ``rows`` has one array of cell texts per table row, with a zero-based page and a row number.
    Every cell that looks like a variable name yields an entry: its label is the second cell, its
    codes come from the fourth. The last entry of a name in reading order wins.
    """
    width = F.size(cells)
    label = F.when(width > 1, stripped(or_empty(F.get(cells, F.lit(1))))).otherwise(NO_LABEL)
    codes = F.get(cells, F.lit(3))
    # The codes are parsed after deduplication, so losing entries cost no parsing.
    entries = (
        rows.select(
            F.col(page).alias("_page"),
            F.col(row).alias("_row"),
            label.alias("label"),
            codes.alias("_codes"),
            F.posexplode(cells).alias("_cell", "_text"),
        )
        .where(is_variable_name("_text"))
        .withColumn("name", stripped("_text"))
        .drop("_text")
    )
    return keep_last(entries, ["name"], "_page", "_row", "_cell").select(
        "name",
        "label",
        code_label_map("_codes").alias("fatores"),
        (F.col("_page") + 1).alias("pagina"),
    )
