"""Message texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notification texts by event kind.  A null argument prints as
# "null", which format_string does and concat would not.
_CREATED = "Shipment %s has been created and is being prepared for transport to %s."
_SCANNED = "Shipment %s has been scanned at %s. Current destination: %s."
_DELIVERED = "Shipment %s has been successfully delivered to %s."

# Customer texts by channel, kept in the language they are sent
# in.  {brand} is the sender's name, a parameter here.
CUSTOMER_TEMPLATES = (
    (
        "shipment-created",
        "🐾 Ihre {brand} Sendung ist unterwegs!",
        "Ihre Sendung %1$s ist unterwegs nach %2$s! Wir halten Sie auf dem Laufenden.",
        "🐾 {brand}: Sendung %1$s → %2$s",
    ),
    (
        "shipment-scanned",
        "📍 {brand} Sendungsupdate",
        "Update: Ihre Sendung %1$s macht Fortschritte Richtung %2$s.",
        "📍 {brand}: %1$s gescannt → %2$s",
    ),
    (
        "shipment-delivered",
        "🎉 {brand} Zustellung erfolgreich!",
        "Großartig! Ihre Sendung %1$s wurde erfolgreich in %2$s zugestellt!",
        "🎉 {brand}: %1$s zugestellt in %2$s!",
    ),
)
DEFAULT_TEMPLATE = "shipment-created"
CUSTOMER_NAME_PREFIX = "Demo Kunde "
CUSTOMER_ID_PREFIX = "CUSTOMER-"
UNKNOWN_CUSTOMER = "DEMO"


def created_message(shipment_id="shipment_id", destination="destination") -> Column:
    return F.format_string(_CREATED, shipment_id, destination)


def scanned_message(shipment_id="shipment_id", location="location", destination="destination") -> Column:
    return F.format_string(_SCANNED, shipment_id, location, destination)


def delivered_message(shipment_id="shipment_id", location="location") -> Column:
    return F.format_string(_DELIVERED, shipment_id, location)


def default_customer(customer_id, shipment_id) -> Column:
    """The customer, or one named after the last three characters of the shipment id."""
    return F.coalesce(
        customer_id, F.concat(F.lit(CUSTOMER_ID_PREFIX), F.right(shipment_id, F.lit(3)))
    )


def customer_name(customer_id) -> Column:
    named = F.coalesce(F.nullif(customer_id, F.lit("")), F.lit(UNKNOWN_CUSTOMER))
    return F.concat(F.lit(CUSTOMER_NAME_PREFIX), F.right(named, F.lit(3)))


def customer_template(event_type, channel: int, brand: str) -> Column:
    """Template text of one channel (1 subject, 2 body, 3 short message) for an
    event type; types without a template use the default one."""
    texts = {row[0]: row[channel].replace("{brand}", brand) for row in CUSTOMER_TEMPLATES}
    choice = F.lit(texts[DEFAULT_TEMPLATE])
    for name, text in texts.items():
        if name != DEFAULT_TEMPLATE:
            choice = F.when(event_type == name, F.lit(text)).otherwise(choice)
    return choice
