"""Request and record validation; each yields the first failure's message or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.functions import text


def scan_error(shipment_id="shipment_id", location="location") -> Column:
    """A blank id is not rejected here; it will not be found later."""
    shipment_id, location = F.col(shipment_id), F.col(location)
    return text.first_failure(
        (shipment_id.isNull(), "Shipment ID cannot be null"),
        (location.isNull(), "Location cannot be null"),
        (text.is_empty(location), "Location cannot be empty"),
    )


def create_error(origin="origin", destination="destination", customer_id="customer_id") -> Column:
    return text.first_failure(
        (text.is_empty(origin), "Origin must not be blank"),
        (text.is_empty(destination), "Destination must not be blank"),
        (text.is_empty(customer_id), "CustomerId must not be blank"),
    )


def notification_error(shipment_id="shipment_id", message="message", type_="type", absent=None) -> Column:
    """``absent`` is true for a row that stands for no notification at all."""
    checks = [] if absent is None else [(absent, "Notification must not be null")]
    return text.first_failure(
        *checks,
        (text.is_empty(shipment_id), "Notification shipmentId must not be null or empty"),
        (text.is_empty(message), "Notification message must not be null or empty"),
        (F.col(type_).isNull(), "Notification type must not be null"),
    )
