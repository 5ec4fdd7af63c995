"""Fixed schemas and enumerations of the event model."""

from __future__ import annotations

from pyspark.sql import types as T

# Topics, event type names, states and notification types.
TOPIC_CREATED = "shipment-created"
TOPIC_SCANNED = "shipment-scanned"
TOPIC_DELIVERED = "shipment-delivered"
TOPIC_DELIVERY_ANALYTICS = "delivery-analytics"
TOPIC_NOTIFICATION_SENT = "notification-sent"

CREATED_EVENT = "ShipmentCreatedEvent"
SCANNED_EVENT = "ShipmentScannedEvent"
DELIVERED_EVENT = "ShipmentDeliveredEvent"
NOTIFICATION_SENT_EVENT = "NotificationSentEvent"

CREATED = "CREATED"
IN_TRANSIT = "IN_TRANSIT"
DELIVERED = "DELIVERED"

NOTIFICATION_TYPES = ("SHIPMENT_CREATED", "SHIPMENT_SCANNED", "SHIPMENT_DELIVERED")

DEFAULT_VERSION = "v1"
DEAD_LETTER_SUFFIX = ".DLT"

# Which event class a topic carries when a record names none itself.
EVENT_OF_TOPIC = {
    TOPIC_CREATED: CREATED_EVENT,
    TOPIC_SCANNED: SCANNED_EVENT,
    TOPIC_DELIVERED: DELIVERED_EVENT,
    TOPIC_NOTIFICATION_SENT: NOTIFICATION_SENT_EVENT,
}

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(fields: str) -> T.StructType:
    """``name type, ...`` as a schema, without needing a session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_ENVELOPE = "correlationId string, timestamp string, version string, eventType string"

# On the wire every date is text or a number array, so it is read as a string.
WIRE = {
    event: struct(f"{fields}, {_ENVELOPE}")
    for event, fields in {
        CREATED_EVENT: "shipmentId string, destination string, createdAt string",
        SCANNED_EVENT: "shipmentId string, location string, scannedAt string, destination string",
        DELIVERED_EVENT: "shipmentId string, destination string, location string, deliveredAt string",
        NOTIFICATION_SENT_EVENT: "notificationId string, shipmentId string, type string, message string",
    }.items()
}

# A record as it lies in a topic; ``type_id`` is the producer's class header.
RECORD = struct(
    "topic string, partition int, offset bigint, timestamp timestamp_ntz, "
    "type_id string, key string, value string"
)

DELIVERY_COUNT = struct(
    "location string, window_start timestamp_ntz, window_end timestamp_ntz, count bigint"
)

SHIPMENT_STATE = struct(
    "shipment_id string, destination string, last_location string, created_at timestamp_ntz, "
    "last_scanned_at timestamp_ntz, delivered_at timestamp_ntz, status string"
)

WEBHOOK = struct(
    "eventType string, shipmentId string, customerId string, origin string, "
    "destination string, timestamp bigint, correlationId string"
)
