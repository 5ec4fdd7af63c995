"""Queries on notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import events, notify, records
from waybill.plans.lifecycle import replayed
from waybill.sources import stored, tables

BRAND = "Waybill"
SHIPMENT = " 42 "
# sha256 of "shipment-created:0:0", the record of order 0
FIRST_CREATED = "bc4963d1b019215ba3be2ebe19b9460b217fe3d75ddcbfe8ea99b03267c9a401"


def all_events(spark: SparkSession, sf_dir: str, shipment_id: str | None = None) -> DataFrame:
    """Created events, and scanned and delivered ones from one replay; of all
    shipments or of one."""
    created = tables.created(spark, sf_dir, shipment_id)
    return events.created_events(created).unionByName(
        events.replayed_events(replayed(spark, sf_dir, shipment_id))
    )


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notify.notifications(all_events(spark, sf_dir))


def notifications_for_shipment(spark, sf_dir):
    notes = notify.notifications(all_events(spark, sf_dir, SHIPMENT.strip()))
    return notify.notifications_for_shipment(notes, SHIPMENT)


def notification_by_id(spark, sf_dir):
    """The notification of the first order's creation, by its id with blanks around."""
    return notify.notification_by_id(notifications(spark, sf_dir), f"  {FIRST_CREATED}\t")


def notification_count(spark, sf_dir):
    return notify.notification_count(notifications(spark, sf_dir))


def recent_notifications(spark, sf_dir):
    return notify.recent_notifications(notifications(spark, sf_dir))


def notifications_by_type(spark, sf_dir):
    return notify.notifications_by_type(notifications(spark, sf_dir))


def notifications_by_shipment(spark, sf_dir):
    return notify.notifications_by_shipment(notifications(spark, sf_dir))


def busiest_shipments(spark, sf_dir):
    return notify.notifications_by_shipment(notifications(spark, sf_dir), top_n=10)


def _inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer", "supplier", "nation")]


def _usable(spark, sf_dir) -> DataFrame:
    return notify.usable(all_events(spark, sf_dir))


def _made(rows: DataFrame, *also: str) -> DataFrame:
    return notify.worded(notify.identified(rows, *also), *also)


def _buckets(spark, sf_dir) -> int:
    """By the number of orders and scans, which the files' footers tell; deliveries are few."""
    rows = tables.order_ids(spark, sf_dir).count() + tables.scan_keys(spark, sf_dir).count()
    return stored.buckets_of(rows * stored.NOTE_BYTES)


def _stored(spark, sf_dir) -> DataFrame:
    """All notifications as a table by shipment, made once in a session."""
    return stored.once(
        spark, "notifications", _inputs(sf_dir),
        lambda folder: stored.write_notifications(
            _usable(spark, sf_dir), folder, _buckets(spark, sf_dir), make=_made
        ),
    )


def notifications_for_shipment_stored(spark, sf_dir):
    rows = stored.notifications_of(_stored(spark, sf_dir), SHIPMENT)
    return notify.notifications_for_shipment(rows, SHIPMENT)


def notification_by_id_stored(spark, sf_dir):
    rows = _stored(spark, sf_dir).drop("buckets", "bucket")
    return notify.notification_by_id(rows, f"  {FIRST_CREATED}\t")


def notification_count_stored(spark, sf_dir):
    return notify.notification_count(_stored(spark, sf_dir))


def notifications_by_type_stored(spark, sf_dir):
    return notify.notifications_by_type(_stored(spark, sf_dir))


def recent_notifications_stored(spark, sf_dir):
    """Of the newest days alone."""
    by_day = stored.once(
        spark, "notifications-by-day", _inputs(sf_dir),
        lambda folder: stored.write_by_day(_usable(spark, sf_dir), folder, make=_made),
    )
    return notify.recent_notifications(stored.newest_days(by_day, notify.LATEST))


def deletion_results_stored(spark, sf_dir):
    return notify.deletion_results(_stored(spark, sf_dir), _deletions(spark, sf_dir))


def notification_preview(spark, sf_dir):
    return notify.notification_preview(notifications(spark, sf_dir))


def notification_type_parse(spark, sf_dir):
    key = F.col("event_id")
    raw = (
        F.when(key % 4 == 0, F.lit("shipment_scanned"))
        .when(key % 4 == 1, F.lit("SHIPMENT_DELIVERED"))
        .when(key % 4 == 2, F.col("event_type"))
    )
    rows = tables.table(spark, sf_dir, "events").select("event_id", raw.alias("raw_type"))
    return notify.notification_type_parse(rows)


def _dirty(spark, sf_dir):
    """Created notifications with parts missing."""
    key = F.col("shipment_id").cast("bigint")
    created = events.created_events(tables.created(spark, sf_dir))
    notes = notify.notifications(created).withColumn("key", key)
    return notes.select(
        "id",
        "key",
        F.when(F.col("key") % 5 == 0, F.lit("\t ")).otherwise(F.col("shipment_id")).alias("shipment_id"),
        F.when(F.col("key") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("message")).alias("message"),
        F.when(F.col("key") % 11 != 0, F.col("type")).alias("type"),
    )


def notification_validation(spark, sf_dir):
    return notify.notification_validation(_dirty(spark, sf_dir), absent=F.col("key") % 13 == 0)


def _deletions(spark, sf_dir):
    """Delete the notifications of all orders' creations: some by a blank id or one
    that is not there, every ninth a second time."""
    key = F.col("o_orderkey")
    record = F.concat_ws(":", F.lit(S.TOPIC_CREATED), key % 3, F.expr("o_orderkey div 3"))
    times = F.when(key % 9 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    asked = tables.table(spark, sf_dir, "orders").select("o_orderkey", F.explode(times).alias("again"))
    return asked.select(
        (key * 2 + F.col("again")).alias("request_id"),
        F.when(key % 7 == 0, F.lit(" "))
        .when(key % 5 == 0, F.concat(F.lit("gone-"), key.cast("string")))
        .otherwise(F.concat(F.lit(" "), F.sha2(record, 256)))
        .alias("id")
    )


def delete_notifications(spark, sf_dir):
    """Deleted by id before the texts are made."""
    identified = notify.identified(_usable(spark, sf_dir))
    return notify.worded(notify.delete_notifications(identified, _deletions(spark, sf_dir)))


def deletion_results(spark, sf_dir):
    return notify.deletion_results(notifications(spark, sf_dir), _deletions(spark, sf_dir))


def deletion_counts(spark, sf_dir):
    return notify.deletion_counts(notifications(spark, sf_dir), _deletions(spark, sf_dir))


def delete_all_notifications(spark, sf_dir):
    return notify.deletion_counts(notifications(spark, sf_dir))


def notification_sent_records(spark, sf_dir):
    return records.notification_sent_records(notifications(spark, sf_dir))


def event_records(spark, sf_dir):
    return records.event_records(all_events(spark, sf_dir))


def webhook_payloads(spark, sf_dir):
    return records.webhook_payloads(all_events(spark, sf_dir))


def customer_messages(spark, sf_dir):
    """Some payloads have no customer, no destination or a type without a template."""
    key = F.col("timestamp") / 86_400_000 % 7
    payloads = records.webhook_payloads(all_events(spark, sf_dir)).select(
        F.when(key == 1, F.lit("shipment-lost")).otherwise(F.col("eventType")).alias("eventType"),
        "shipmentId",
        F.when(key == 2, F.lit("")).when(key != 3, F.col("customerId")).alias("customerId"),
        F.when(key != 4, F.col("destination")).alias("destination"),
        F.when(key != 5, F.col("timestamp")).alias("timestamp"),
    )
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return records.customer_messages(payloads, BRAND, now)


def event_metrics(spark, sf_dir):
    """Every 97th created payload is cut off."""
    payloads = records.webhook_payloads(all_events(spark, sf_dir))
    body = F.to_json(F.struct("*"))
    broken = (F.col("eventType") == S.TOPIC_CREATED) & (F.col("shipmentId").cast("bigint") % 97 == 0)
    bodies = payloads.select(
        F.when(broken, F.substr(body, F.lit(1), F.char_length(body) - 3)).otherwise(body).alias("body")
    )
    return records.event_metrics(bodies)


QUERIES = {
    "notifications": notifications,
    "notifications_for_shipment": notifications_for_shipment,
    "notification_by_id": notification_by_id,
    "notification_count": notification_count,
    "recent_notifications": recent_notifications,
    "notifications_by_type": notifications_by_type,
    "notifications_by_shipment": notifications_by_shipment,
    "busiest_shipments": busiest_shipments,
    "notifications_for_shipment_stored": notifications_for_shipment_stored,
    "notification_by_id_stored": notification_by_id_stored,
    "notification_count_stored": notification_count_stored,
    "notifications_by_type_stored": notifications_by_type_stored,
    "recent_notifications_stored": recent_notifications_stored,
    "deletion_results_stored": deletion_results_stored,
    "notification_preview": notification_preview,
    "notification_type_parse": notification_type_parse,
    "notification_validation": notification_validation,
    "delete_notifications": delete_notifications,
    "deletion_results": deletion_results,
    "deletion_counts": deletion_counts,
    "delete_all_notifications": delete_all_notifications,
    "notification_sent_records": notification_sent_records,
    "event_records": event_records,
    "webhook_payloads": webhook_payloads,
    "customer_messages": customer_messages,
    "event_metrics": event_metrics,
}
