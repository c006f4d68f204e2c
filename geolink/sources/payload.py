"""Official municipality list from JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD_TYPE = "array<struct<id:bigint,nome:string>>"

# Why a payload is not used.
NO_PAYLOAD = "no payload"
NOT_A_LIST = "no JSON array of objects"
NO_ID = "an object without a whole number as id"


def payload_fault(payload: Column, items: Column) -> Column:
    """Why a payload is bad, or null; ``items`` is what it was parsed to."""
    return (
        F.when(payload.isNull() | (F.trim(payload) == ""), NO_PAYLOAD)
        .when(items.isNull() | F.exists(items, lambda i: i.isNull()), NOT_A_LIST)
        .when(F.exists(items, lambda i: i["id"].isNull()), NO_ID)
    )


def parsed_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payloads with their ``items``, and the ``fault`` of those that are bad."""
    items = F.from_json(F.col(column), PAYLOAD_TYPE)
    return payloads.withColumn("items", items).withColumn("fault", payload_fault(F.col(column), F.col("items")))


def _rows(parsed: DataFrame) -> DataFrame:
    items = parsed.select(F.inline("items"))
    return items.select(
        F.col("id").cast("string").alias("municipio_codigo_7"),
        F.col("nome").alias("municipio_nome_api"),
    )


def official_municipalities(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Rows ``(municipio_codigo_7, municipio_nome_api)`` of JSON arrays of objects, one per row.

    A bad payload, such as one that was cut short, is an error.
    """
    parsed = parsed_payloads(payloads, column)
    message = F.concat(F.lit("bad payload: "), F.col("fault"), F.lit(": "), F.coalesce(F.substring(column, 1, 80), F.lit("null")))
    good = F.when(F.col("fault").isNull(), F.col("items")).otherwise(
        F.raise_error(message).cast(PAYLOAD_TYPE)
    )
    return _rows(parsed.withColumn("items", good))


def split_payloads(payloads: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """The rows of the good payloads, and the bad payloads with their ``fault``, all columns kept."""
    parsed = parsed_payloads(payloads, column)
    return _rows(parsed.where("fault is null")), parsed.where("fault is not null").drop("items")


def fault_counts(quarantined: DataFrame) -> DataFrame:
    """How many inputs were set aside, by fault."""
    return quarantined.groupBy("fault").agg(F.count("*").alias("n"))
