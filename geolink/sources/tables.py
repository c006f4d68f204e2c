"""Table scans, with provenance where row order matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolink.operators.staging import stage_table

#: More rows than a file can have, few enough for eight million files.
ROWS_PER_FILE = 2**40


def read_aligned(spark: SparkSession, *paths: str) -> DataFrame:
    """One Parquet table from one or many paths, with every column that any file has.

    Columns are aligned by name, null where a file lacks them; one name with two types is an error.
    The footers are read by a job, and the plan is one scan, however many files there are.
    """
    return spark.read.option("mergeSchema", True).parquet(*paths)


def read_table(spark: SparkSession, *paths: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One Parquet table from one or many paths; an absent path raises at once."""
    df = read_aligned(spark, *paths)
    return df.select(*columns) if columns else df


def read_table_in_order(spark: SparkSession, *paths: str, ordinal: str = "ord") -> DataFrame:
    """A Parquet table with the position of each row, as a whole number: file name, then row in the file.

    First-wins rules need the position, since a distributed scan has no order of its own. The number is
    the file's place among the files by name, times ``ROWS_PER_FILE``, and the row's place in the file. Only
    the files, a row each, are brought in order. Columns that only some files have are kept, see
    ``read_aligned``.
    """
    df = read_aligned(spark, *paths)
    files = df.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_name"))
    by_name = Window.orderBy("_name", "_path")
    places = files.distinct().select("_path", (F.row_number().over(by_name) - 1).cast("long").alias("_place"))
    rows = df.select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row")
    )
    position = F.col("_place") * ROWS_PER_FILE + F.col("_row")
    placed = rows.join(F.broadcast(places), "_path")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], position.alias(ordinal))


def column_names(spark: SparkSession, *paths: str) -> list[str]:
    """Column names from the file footers alone."""
    return read_aligned(spark, *paths).columns


def count_rows(spark: SparkSession, *paths: str) -> int:
    """Row count, answered from Parquet metadata."""
    return spark.read.parquet(*paths).count()


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def csv_position() -> Column:
    """Row position in CSV input: file, block in the file, row in the block."""
    return F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored under ``path``, on whatever file system it names."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_text_csv(
    spark: SparkSession, path: str, names: Sequence[str], ordinal: str | None = None
) -> DataFrame:
    """A CSV with a header, every column text.

    A missing file gives an empty table, and a column that the file lacks is null. With
    ``ordinal`` the row position comes along.
    """
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], text_schema(names))
        position = "struct<file_path:string,file_block_start:bigint,row:bigint>"
        return empty.withColumn(ordinal, F.lit(None).cast(position)) if ordinal else empty
    raw = spark.read.option("header", True).csv(path)
    columns = [
        F.col(f"`{n}`") if n in raw.columns else F.lit(None).cast("string").alias(n) for n in names
    ]
    return raw.select(*columns, *([csv_position().alias(ordinal)] if ordinal else []))


WRONG_COLUMNS = "another number of columns than the header"


def split_text_csv(
    spark: SparkSession, path: str, names: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """A CSV as text columns like ``read_text_csv``, and apart from it the lines that do not fit its header.

    A line with too many or too few columns is set aside whole, as ``(line, fault)``.
    """
    header = spark.read.option("header", True).csv(path).columns
    corrupt = "_corrupt_record"
    schema = text_schema([*header, corrupt])
    raw = spark.read.schema(schema).options(
        header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt
    ).csv(path)
    # Parsed once for both; the record column cannot be read alone.
    raw = stage_table(raw, "lines")
    columns = [
        F.col(f"`{n}`") if n in header else F.lit(None).cast("string").alias(n) for n in names
    ]
    bad = raw.where(F.col(corrupt).isNotNull())
    return (
        raw.where(F.col(corrupt).isNull()).select(*columns),
        bad.select(F.col(corrupt).alias("line"), F.lit(WRONG_COLUMNS).alias("fault")),
    )


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Fail early when an input table is empty."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def require_paths(spark: SparkSession, *paths: str) -> None:
    """Fail early when an input is missing."""
    absent = [p for p in paths if not path_exists(spark, p)]
    if absent:
        raise FileNotFoundError(f"missing inputs: {absent}")
