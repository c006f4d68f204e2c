"""Written stage tables: cut lineage and hand a table on, through the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as the cluster names it.

    A local session, where driver and executors share one disk, gets a folder of its own when the
    setting is absent. On a cluster that would lose data, so it is an error there.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="geolink-")
    return _local_folders[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path for one stage table."""
    return f"{shared_folder(spark)}/geolink/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet and return the written table.

    Unlike a cached table it survives the loss of executors, and unlike a checkpointed RDD it keeps
    column pruning, filter pushdown and file sizes for the planner.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
