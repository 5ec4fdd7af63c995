"""Queries on shipments, scans and deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.operators import creation, gate, lifecycle
from waybill.operators.skew import NoHotKeys
from waybill.sources import stored, tables

SHIPMENT = "42"


def replayed(spark: SparkSession, sf_dir: str, shipment_id: str | None = None) -> DataFrame:
    """All scans replayed, or those of one shipment, which are picked out first.  Their
    ids are made after the replay, so that they neither travel nor are sorted."""
    scans = tables.bare_scans(spark, sf_dir, shipment_id)
    one = shipment_id is not None
    return tables.with_ids(
        lifecycle.replay(
            scans, tables.SCAN_ORDER, tables.scan_chunk(),
            keys=None if one else tables.scan_keys(spark, sf_dir), hot=NoHotKeys() if one else None,
        )
    )


def shipment_lifecycle(spark, sf_dir):
    return lifecycle.lifecycle(replayed(spark, sf_dir))


def delivered_events(spark, sf_dir):
    return lifecycle.delivered_events(replayed(spark, sf_dir))


def delivered_events_first(spark, sf_dir):
    return lifecycle.delivered_events(replayed(spark, sf_dir), dedupe=True)


def shipment_state(spark, sf_dir):
    return lifecycle.shipment_state(replayed(spark, sf_dir))


def shipment_by_id(spark, sf_dir):
    state = lifecycle.shipment_state(replayed(spark, sf_dir, SHIPMENT))
    return lifecycle.response(lifecycle.shipment_by_id(state, SHIPMENT))


def shipment_responses(spark, sf_dir):
    return lifecycle.response(shipment_state(spark, sf_dir))


def status_lookup(spark, sf_dir):
    return lifecycle.status_lookup(tables.order_ids(spark, sf_dir), shipment_state(spark, sf_dir))


def stored_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of all shipments as a table in buckets, made once in a session."""
    inputs = [f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer", "supplier", "nation")]
    return stored.once_bucketed(
        spark, "shipment-state", inputs, lambda: shipment_state(spark, sf_dir), "shipment_id"
    )


def status_lookup_stored(spark, sf_dir):
    return lifecycle.status_lookup(tables.order_ids(spark, sf_dir), stored_state(spark, sf_dir))


def shipment_by_id_stored(spark, sf_dir):
    return lifecycle.response(lifecycle.shipment_by_id(stored_state(spark, sf_dir), SHIPMENT))


def _marked(spark, sf_dir):
    return lifecycle.mark_delivered(
        tables.delivery_requests(spark, sf_dir), shipment_state(spark, sf_dir)
    )


def mark_delivered(spark, sf_dir):
    return _marked(spark, sf_dir).drop("destination")


def manual_deliveries(spark, sf_dir):
    return lifecycle.manual_deliveries(_marked(spark, sf_dir))


def state_after_manual(spark, sf_dir):
    return lifecycle.apply_deliveries(shipment_state(spark, sf_dir), _marked(spark, sf_dir))


def known_shipments(spark, sf_dir):
    return gate.known_shipments(tables.recreated(spark, sf_dir))


def _results(spark, sf_dir):
    return gate.scan_results(
        tables.scan_requests(spark, sf_dir),
        tables.recreated(spark, sf_dir),
        tables.SCAN_ORDER,
        keys=tables.request_keys(spark, sf_dir),
    )


def scan_results(spark, sf_dir):
    return gate.scan_answers(_results(spark, sf_dir))


def scan_accepted(spark, sf_dir):
    return gate.scan_accepted(_results(spark, sf_dir))


def scan_rejected(spark, sf_dir):
    return gate.early_requests(tables.scan_requests(spark, sf_dir), tables.recreated(spark, sf_dir))


def scan_state(spark, sf_dir):
    return gate.scan_state(
        tables.scan_requests(spark, sf_dir), tables.recreated(spark, sf_dir), tables.SCAN_ORDER
    )


def scan_known_check(spark, sf_dir):
    return gate.scan_known_check(tables.lookups(spark, sf_dir), known_shipments(spark, sf_dir))


def create_validation(spark, sf_dir):
    return creation.create_validation(tables.shipment_requests(spark, sf_dir))


def create_shipments(spark, sf_dir):
    return creation.create_shipments(tables.shipment_requests(spark, sf_dir))


def delete_shipments(spark, sf_dir):
    """Shipments that were ever scanned are deleted."""
    rows = tables.shipments(spark, sf_dir).select("shipment_id", "destination")
    return creation.delete_shipments(rows, tables.scan_keys(spark, sf_dir))


QUERIES = {
    "shipment_lifecycle": shipment_lifecycle,
    "delivered_events": delivered_events,
    "delivered_events_first": delivered_events_first,
    "shipment_state": shipment_state,
    "shipment_by_id": shipment_by_id,
    "shipment_responses": shipment_responses,
    "status_lookup": status_lookup,
    "status_lookup_stored": status_lookup_stored,
    "shipment_by_id_stored": shipment_by_id_stored,
    "mark_delivered": mark_delivered,
    "manual_deliveries": manual_deliveries,
    "state_after_manual": state_after_manual,
    "known_shipments": known_shipments,
    "scan_results": scan_results,
    "scan_accepted": scan_accepted,
    "scan_rejected": scan_rejected,
    "scan_state": scan_state,
    "scan_known_check": scan_known_check,
    "create_validation": create_validation,
    "create_shipments": create_shipments,
    "delete_shipments": delete_shipments,
}
