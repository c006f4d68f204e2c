"""Writing tables, samples and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str] = (),
    compression: str = "snappy",
    partition_by: Sequence[str] = (),
) -> None:
    """Replace a Parquet table. ``sort_by`` orders it by range over all tasks, nulls last."""
    if sort_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in sort_by])
    writer = df.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_observed(
    df: DataFrame, path: str, aggregates: Sequence[Column], sort_by: Sequence[str] = ()
) -> DataFrame:
    """Replace a Parquet table and give one row of aggregates over it, from the pass that writes it.

    The aggregates are watched above the sort, whose sampling would count rows twice.
    """
    if sort_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in sort_by])
    watched = Observation()
    write_table(df.observe(watched, *aggregates), path)
    schema = df.agg(*aggregates).schema
    return df.sparkSession.createDataFrame([tuple(watched.get[c] for c in schema.names)], schema)


def write_enriched(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the enriched case table, compressed with zstd."""
    write_table(df, path, compression="zstd", partition_by=partition_by)


def _csv(writer: DataFrameWriter) -> DataFrameWriter:
    # Blanks in keys are data; without the options the writer would trim them.
    return writer.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_csv(
    df: DataFrame, path: str, order: Sequence[Column] = (), n: int | None = None
) -> None:
    """Replace a CSV with a header: the whole table, or the first ``n`` rows as one file."""
    if order:
        df = df.orderBy(*order)
    if n is not None:
        df = df.limit(n).coalesce(1)
    _csv(df.write.mode("overwrite")).csv(path)


def write_metrics(metrics: DataFrame, path: str, kind: str = "csv") -> None:
    """Replace a summary; a metrics table has a few dozen rows, so it becomes one file."""
    writer = metrics.coalesce(1).write.mode("overwrite")
    if kind == "csv":
        _csv(writer).csv(path)
    else:
        writer.json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Replace a table of nested JSON documents, one per line."""
    df.write.mode("overwrite").json(path)


def save_batch(df: DataFrame, path: str, batch: int) -> None:
    """Keep a numbered batch of results beside the others; saving a batch again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")
