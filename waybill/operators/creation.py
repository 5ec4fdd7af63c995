"""New shipments from requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators.validate import create_error


def create_validation(requests: DataFrame) -> DataFrame:
    return requests.select("request_id", create_error().alias("error_message"))


def create_shipments(requests: DataFrame) -> DataFrame:
    """State rows of the valid requests.

    The id is the whole hash of the request id, so a replay makes the same
    shipments and no two requests share one.
    """
    return requests.filter(create_error().isNull()).select(
        "request_id",
        F.sha2(F.col("request_id"), 256).alias("shipment_id"),
        "origin",
        "destination",
        "customer_id",
        F.col("requested_at").alias("created_at"),
        F.lit(S.CREATED).alias("status"),
    )


def created_events(shipments: DataFrame) -> DataFrame:
    return shipments.select(
        "shipment_id", "destination", "created_at", F.col("request_id").alias("correlation_id")
    )


def delete_shipments(shipments: DataFrame, deletions: DataFrame) -> DataFrame:
    """Shipments whose id is not among ``deletions``, each taken once before the join."""
    ids = deletions.select("shipment_id").distinct()
    return shipments.join(ids, "shipment_id", "left_anti")
