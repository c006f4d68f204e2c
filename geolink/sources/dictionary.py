"""Variable dictionary documents."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

try:
    import yaml
except ImportError:
    yaml = None

VARIABLE_SCHEMA = (
    "name string, group string, label string, description string, domain_type string, "
    "values map<string,string>, annex_ref string"
)


def read_document(spark: SparkSession, path: str, kind: str | None = None) -> dict:
    """A dictionary document from YAML or JSON. It describes columns, so it is small by nature.

    Without a ``kind`` the end of the path tells which.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    if (kind or path.rsplit(".", 1)[-1]) == "json":
        return json.loads(text)
    if yaml is None:
        raise RuntimeError("reading a YAML dictionary needs PyYAML; JSON works without it")
    return yaml.safe_load(text)


def variable_table(spark: SparkSession, document: Mapping) -> DataFrame:
    """One row per described variable."""
    rows = [
        (
            name,
            entry.get("group"),
            entry.get("label"),
            entry.get("description"),
            entry.get("domain_type"),
            {str(k): str(v) for k, v in entry["values"].items()} if entry.get("values") else None,
            entry.get("annex_ref"),
        )
        for name, entry in document.get("variables", {}).items()
    ]
    return spark.createDataFrame(rows, VARIABLE_SCHEMA)


def external_names(spark: SparkSession, document: Mapping) -> DataFrame:
    """Variables whose codes an external lookup explains."""
    names = document.get("external_lookup_variables", [])
    return spark.createDataFrame([(n,) for n in names], "name string")


def declared_names(spark: SparkSession, document: Mapping) -> DataFrame:
    """Every name the document declares, described or external, once."""
    described = variable_table(spark, document).select("name")
    return described.unionAll(external_names(spark, document)).distinct()


def variable_counts(document: Mapping) -> tuple[int, int]:
    """How many variables a document describes, and how many it leaves to external lookups."""
    return len(document.get("variables", {})), len(document.get("external_lookup_variables", []))
