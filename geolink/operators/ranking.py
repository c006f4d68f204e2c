"""Top-N rows: nulls last in both directions, and a unique tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geolink.operators.staging import stage_table


def order_columns(descending: Sequence[str] = (), ascending: Sequence[str] = ()) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in descending] + [
        F.col(c).asc_nulls_last() for c in ascending
    ]


def top_n(
    df: DataFrame, n: int, descending: Sequence[str] = (), ascending: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` rows by the descending, then the ascending columns."""
    return df.orderBy(*order_columns(descending, ascending)).limit(n)


def top_n_per_group(
    df: DataFrame,
    group: str,
    n: int,
    descending: Sequence[str] = (),
    ascending: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` rows of each group; at most ``n`` per group and task are shuffled."""
    order = Window.partitionBy(group).orderBy(*order_columns(descending, ascending))
    return df.withColumn("_rank", F.row_number().over(order)).where(f"_rank <= {n}").drop("_rank")


def numbered(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Rows with their number, from 1, in an order whose directions may differ.

    No task sees all rows, as it would in a window over the whole table: rows are sorted by range and
    written with their place in their partition, and the partitions' sizes, one row each, are added up.
    Rows that are equal in all the columns are numbered in any order.
    """
    place, part = "_place", "_part"
    placed = stage_table(
        df.orderBy(*order).withColumn(
            place, F.monotonically_increasing_id()
        ),
        "numbered",
    )
    # The id has the partition in the bits above 33, and the row in those below.
    placed = placed.withColumn(part, F.shiftright(place, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_held")).select(
        part, F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_offset")
    )
    number = F.col("_offset") + F.col(place).bitwiseAND(F.lit(2**33 - 1)) + 1
    joined = placed.join(F.broadcast(offsets), part)
    return joined.withColumn(name, number).drop(place, part, "_offset")
