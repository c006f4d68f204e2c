"""Footers of Parquet files, read by tasks: what is in many files, without reading them.

A table is a file, or a folder of part files as Spark writes it; its name is the last part of its path, of
``key=value`` the value. The listing is spread over tasks, which read the footers and no more than the first
record. They open files by themselves, so the file system must be local, mounted, or known to Arrow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolink.session import ship_code

FOOTER = (
    "path string, name string, part string, n_rows bigint, n_columns int,"
    " position int, column string, type string, first string"
)


def list_parts(spark: SparkSession, *folders: str, pattern: str = "*") -> DataFrame:
    """Files as ``(path, name, part)``: the table's path and name, and the file; no content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(list(folders))
        .select(F.col("path").alias("part"))
    )
    return files.select(
        F.regexp_replace("part", "/part-[^/]*$", "").alias("path"), "part"
    ).select("path", F.regexp_extract("path", "([^/=]+)/*$", 1).alias("name"), "part")


def open_parquet(path: str) -> pq.ParquetFile:
    local = re.sub("^file:/+", "/", path)
    if local.startswith("/"):
        return pq.ParquetFile(local)
    system, inner = fs.FileSystem.from_uri(path)
    return pq.ParquetFile(inner, filesystem=system)


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return str(value).lower() if isinstance(value, bool) else str(value)


def footer_rows(path: str, name: str, part: str) -> list[tuple]:
    """One row for each column of a file, with its type and first value; one without a column if it has none."""
    with open_parquet(part) as file:
        # The types that the file has, not those of the program that wrote it.
        fields = list(file.schema.to_arrow_schema())
        n_rows = file.metadata.num_rows
        first = next(file.iter_batches(batch_size=1), None) if n_rows else None
        values = [_text(v) for v in first.slice(0, 1).to_pylist()[0].values()] if first else [None] * len(fields)
    head = (path, name, part, n_rows, len(fields))
    columns = [(*head, i, f.name, str(f.type), v) for i, (f, v) in enumerate(zip(fields, values, strict=True))]
    return columns or [(*head, None, None, None, None)]


TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]


def footers(parts: DataFrame) -> DataFrame:
    """One row for each file and column of a listing by ``list_parts``; see ``FOOTER``."""
    ship_code(parts.sparkSession)
    names = [f.split()[0] for f in FOOTER.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for p in batch.to_pylist() for r in footer_rows(p["path"], p["name"], p["part"])]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return parts.select("path", "name", "part").mapInArrow(read, FOOTER)


def table_columns(found: DataFrame) -> DataFrame:
    """Footers by table: one row for each table and column, with the table's rows and columns.

    ``first`` is the value in the first row of the first part that has rows. A column that only some parts
    have counts; one with two types is an error.
    """
    of_table = ["path", "name"]
    conflict = F.raise_error(F.concat(F.lit("a column with two types: "), F.col("path"), F.lit(" "), F.col("column")))
    columns = (
        found.where("column is not null")
        .groupBy(*of_table, "column")
        .agg(
            F.min("position").alias("position"),
            F.min("type").alias("type"),
            F.max("type").alias("_other"),
            F.min_by("first", F.when(F.col("n_rows") > 0, F.col("part"))).alias("first"),
        )
        .withColumn("type", F.when(F.col("type") == F.col("_other"), F.col("type")).otherwise(conflict.cast("string")))
    )
    # One row for each part.
    rows = found.where("position = 0 or column is null").groupBy(*of_table).agg(F.sum("n_rows").alias("n_rows"))
    counted = columns.groupBy("path").agg(F.count("*").alias("n_columns"))
    tables = rows.join(counted, "path", "left").fillna(0, ["n_columns"])
    return tables.join(columns.drop("name", "_other"), "path", "left")


def table_facts(found: DataFrame) -> DataFrame:
    """Footers by table: ``(path, file, n_rows, n_columns, columns)``, the names in their order."""
    listed = F.sort_array(F.collect_list(F.when(F.col("column").isNotNull(), F.struct("position", "column"))))
    return (
        table_columns(found)
        .groupBy("path", F.col("name").alias("file"), "n_rows", "n_columns")
        .agg(F.array_join(F.transform(listed, lambda c: c["column"]), ",").alias("columns"))
    )


def require_same_columns(found: DataFrame) -> None:
    """Fail unless all files have the same columns with the same types, in any order.

    Files are told apart by a digest of their columns, so that few rows reach the driver.
    """
    shape = F.sort_array(F.collect_list(F.struct("column", "type")))
    shapes = (
        found.groupBy("part").agg(shape.alias("shape")).groupBy("shape").agg(F.min("part").alias("part"))
    )
    kinds = shapes.orderBy("part").limit(2).collect()
    if len(kinds) > 1:
        first, other = ({(c["column"], c["type"]) for c in k["shape"]} for k in kinds)
        differing = sorted({str(c) for c, _ in first ^ other})
        raise ValueError(f"{kinds[1]['part']} differs from {kinds[0]['part']} in columns {differing}")
