"""Choosing input files by the group, state and period in their names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolink.functions.keys import has_period, name_matches, name_month, name_year
from geolink.sources.footers import list_parts


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files of a folder as ``(path, name)``; only the listing is read, not the content.

    A folder of part files counts as one file, see ``footers.list_parts``.
    """
    return list_parts(spark, folder, pattern=pattern).select("path", "name").distinct()


def select_files(
    files: DataFrame,
    prefix: str,
    year: int | None = None,
    month: int | None = None,
    suffix: str = ".dbc",
    cap: int | None = None,
    name: str = "name",
) -> DataFrame:
    """Files by prefix, suffix and period, in name order; ``cap`` keeps the first few.

    Names end in ``yymm`` and the suffix. Prefix and suffix match whatever the case.
    """
    chosen = files.where(name_matches(name, prefix, suffix))
    if year is not None:
        chosen = chosen.where(name_year(name, suffix) == f"{year % 100:02d}")
    if month is not None:
        chosen = chosen.where(name_month(name, suffix) == f"{month:02d}")
    ordered = chosen.orderBy(F.col(name).asc_nulls_last())
    return ordered.limit(cap) if cap is not None else ordered


def find_inputs(
    spark: SparkSession,
    folder: str,
    prefix: str,
    suffix: str = ".parquet",
    year: int | None = None,
    month: int | None = None,
    cap: int | None = None,
) -> list[str]:
    """Paths of the chosen files of a folder, in name order; none is an error."""
    found = select_files(list_files(spark, folder), prefix, year, month, suffix, cap).collect()
    if not found:
        raise FileNotFoundError(f"no file {prefix}*{suffix} in {folder}")
    return [row.path for row in found]


def latest_files(
    files: DataFrame, group: str, suffix: str = ".dbc", name: str = "name", digits: int = 4
) -> DataFrame:
    """Greatest name per group among the names that carry a period; templates do not count."""
    return (
        files.where(F.lower(F.col(name)).endswith(suffix.lower()) & has_period(name, suffix, digits))
        .groupBy(group)
        .agg(F.max(name).alias(name))
    )


def latest_of_groups(
    files: DataFrame, groups: Sequence[str], suffix: str = ".parquet", digits: int = 4
) -> DataFrame:
    """``(group, path, name)`` of the latest file of each group, whose names begin with the group.

    Templates do not count. A group without a file has a row without a path.
    """
    asked = files.sparkSession.createDataFrame([(g,) for g in dict.fromkeys(groups)], "group string")
    group = F.coalesce(*[F.when(name_matches("name", g, suffix), F.lit(g)) for g in groups])
    grouped = files.withColumn("group", group).where(F.col("group").isNotNull())
    latest = latest_files(grouped, "group", suffix, digits=digits)
    found = grouped.join(latest, ["group", "name"]).groupBy("group").agg(
        F.max_by(F.struct("path", "name"), "path").alias("file")
    )
    return asked.join(found, "group", "left").select("group", "file.path", "file.name")


def latest_paths(
    spark: SparkSession,
    folder: str,
    groups: Sequence[str],
    suffix: str = ".parquet",
    digits: int = 4,
) -> dict[str, str]:
    """Path of the latest file of each group; groups without a file are left out."""
    latest = latest_of_groups(list_files(spark, folder), groups, suffix, digits)
    return {row["group"]: row["path"] for row in latest.where("path is not null").collect()}
