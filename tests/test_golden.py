"""Small worked cases, given as literal rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import counts, creation, events, gate, lifecycle, notify, records, validate

DAY = datetime(2024, 1, 15)


def at(hour, minute=0):
    return DAY.replace(hour=hour, minute=minute)


def table(spark, fields, *rows):
    return spark.createDataFrame(list(rows), S.struct(fields))


def deliveries(spark, *rows):
    return table(spark, "shipment_id string, location string, delivered_at timestamp_ntz", *rows)


SCAN = "shipment_id string, location string, scanned_at timestamp_ntz, destination string, correlation_id string"


def scans(spark, *rows):
    return table(spark, SCAN, *rows)


def replay(spark, *rows):
    return lifecycle.replay(scans(spark, *rows), ["scanned_at", "correlation_id"], [F.col("scanned_at")])


def state(spark, *rows):
    return {r["shipment_id"]: r for r in lifecycle.shipment_state(replay(spark, *rows)).collect()}


def delivered(spark, *rows):
    return lifecycle.delivered_events(replay(spark, *rows)).orderBy("delivered_at").collect()


class TestCounts:
    def test_one_delivery(self, spark):
        hourly = counts.delivery_counts(deliveries(spark, ("S", "Berlin", at(10, 30))))
        found = counts.location_counts(hourly, "Berlin", at(9, 30), at(11, 30)).collect()
        assert [tuple(r) for r in found] == [("Berlin", at(10), at(11), 1)]

    def test_three_in_one_window(self, spark):
        rows = [("S", "Berlin", at(11, m)) for m in (1, 2, 3)]
        found = counts.delivery_counts(deliveries(spark, *rows)).collect()
        assert [tuple(r) for r in found] == [("Berlin", at(11), at(12), 3)]

    def test_window_start_belongs_and_end_does_not(self, spark):
        rows = [("S", "Berlin", at(10)), ("S", "Berlin", at(11))]
        found = counts.delivery_counts(deliveries(spark, *rows)).collect()
        assert sorted((r["window_start"], r["count"]) for r in found) == [(at(10), 1), (at(11), 1)]

    def test_location_is_trimmed_but_keeps_its_case(self, spark):
        rows = [("S", x, at(10)) for x in ("Berlin", "\tBerlin ", "berlin", " ", "", None, " ")]
        found = {r["location"]: r["count"] for r in counts.delivery_counts(deliveries(spark, *rows)).collect()}
        assert found == {"Berlin": 2, "berlin": 1, " ": 1}

    def test_range_takes_both_ends_and_the_argument_as_it_is(self, spark):
        rows = [("S", "Berlin", at(h)) for h in (8, 9, 10, 11)]
        hourly = counts.delivery_counts(deliveries(spark, *rows))
        assert counts.counts_in_range(hourly, at(9), at(10)).count() == 2
        assert counts.location_counts(hourly, " Berlin", at(0), at(23)).count() == 0

    def test_a_cap_limits_the_list_only(self, spark):
        rows = [("S", "Berlin", at(h)) for h in range(6)]
        hourly = counts.delivery_counts(deliveries(spark, *rows))
        capped = counts.location_analytics(hourly, "Berlin", at(0), at(23), max_results=4).first()
        assert capped["total_deliveries"] == 6
        assert [h["window_start"] for h in capped["hourly_data"]] == [at(h) for h in range(4)]
        assert (capped["from"], capped["to"]) == (at(0), at(23))
        assert counts.location_counts(hourly, "Berlin", at(0), at(23), max_results=2).count() == 2

    def test_nothing_is_cut_by_default(self, spark):
        start = DAY - timedelta(hours=3000)
        rows = [("S", "Berlin", start + timedelta(hours=h)) for h in range(3000)]
        hourly = counts.delivery_counts(deliveries(spark, *rows))
        whole = counts.location_analytics(hourly, "Berlin", start, DAY).first()
        assert whole["total_deliveries"] == 3000 and len(whole["hourly_data"]) == 3000
        assert counts.location_total(hourly, "Berlin", start, DAY).first()["total_deliveries"] == 3000
        assert counts.counts_in_range(hourly, start, DAY).count() == 3000
        many = [("S", f"L{i}", at(1)) for i in range(1500)]
        assert counts.recent_window_count(counts.delivery_counts(deliveries(spark, *many)), at(1)).first()[0] == 1500

    def test_a_range_of_deliveries_is_enough_for_its_windows(self, spark):
        rows = [("S", "Berlin", at(h) + timedelta(minutes=m)) for h in range(8) for m in (0, 30, 59)]
        events = deliveries(spark, *rows)
        for start, end in ((at(2), at(4)), (at(2) + timedelta(minutes=30), at(4) + timedelta(minutes=30))):
            some = counts.delivery_counts(counts.deliveries_of_range(events, start, end))
            whole = counts.delivery_counts(events)
            picked = [sorted(map(tuple, counts.counts_in_range(c, start, end).collect())) for c in (some, whole)]
            assert picked[0] == picked[1] and picked[0]

    def test_nothing_found(self, spark):
        hourly = counts.delivery_counts(deliveries(spark))
        row = counts.location_analytics(hourly, "Berlin", at(0), at(1)).first()
        assert row["hourly_data"] == [] and row["total_deliveries"] == 0
        assert counts.recent_window_count(hourly, at(1)).first()[0] == 0

    @pytest.mark.parametrize(
        "location, start, end, message",
        [
            (None, DAY, DAY, "Location cannot be null or empty"),
            (" \t", DAY, DAY, "Location cannot be null or empty"),
            ("Berlin", None, DAY, "From date cannot be null"),
            ("Berlin", DAY, None, "To date cannot be null"),
            ("Berlin", at(2), at(1), "From date must be before or equal to to date"),
        ],
    )
    def test_bad_arguments(self, spark, location, start, end, message):
        hourly = counts.delivery_counts(deliveries(spark))
        with pytest.raises(ValueError, match=message):
            counts.location_analytics(hourly, location, start, end)

    def test_retention_is_strict(self, spark):
        rows = [(x, d, d + timedelta(hours=1), 1) for x, d in
                (("old", DAY - timedelta(days=7)), ("kept", DAY - timedelta(days=6, hours=23)), ("new", DAY))]
        kept = counts.retained(spark.createDataFrame(rows, S.DELIVERY_COUNT)).collect()
        assert sorted(r["location"] for r in kept) == ["kept", "new"]

    def test_rate_and_display(self, spark):
        rows = [("a", DAY, DAY + timedelta(minutes=90), 1234), ("b", None, None, 5), ("c", DAY, DAY, 7)]
        shown = {r["location"]: r for r in counts.delivery_rate(spark.createDataFrame(rows, S.DELIVERY_COUNT)).collect()}
        assert shown["a"]["per_hour"] == pytest.approx(822.6667, abs=1e-3)
        assert (shown["a"]["total_display"], shown["a"]["rate_display"]) == ("1,234", "822.7")
        assert (shown["a"]["start_display"], shown["a"]["end_display"]) == ("Jan 15 00:00", "Jan 15 01:30")
        assert (shown["b"]["per_hour"], shown["b"]["start_display"]) == (0.0, "N/A")
        assert shown["c"]["per_hour"] == 0.0


class TestLifecycle:
    def test_scan_elsewhere(self, spark):
        row = state(spark, ("S", "WAREHOUSE_A", at(8), "Berlin", "c"))["S"]
        assert (row["status"], row["last_location"], row["destination"]) == ("IN_TRANSIT", "WAREHOUSE_A", "Berlin")
        assert (row["created_at"], row["last_scanned_at"], row["delivered_at"]) == (at(8), at(8), None)

    def test_scan_at_destination(self, spark):
        rows = [("S", "Depot", at(8), "Berlin", "c1"), ("S", "Berlin", at(9), "Berlin", "c2")]
        assert state(spark, *rows)["S"]["status"] == "DELIVERED"
        assert [tuple(r) for r in delivered(spark, *rows)] == [("S", "Berlin", "Berlin", at(9), "c2")]

    def test_case_does_not_matter_and_the_first_destination_stays(self, spark):
        rows = [("S", "Depot", at(8), "Berlin", "c1"), ("S", "berlin", at(9), "BERLIN", "c2"),
                ("S", "Paris", at(10), "Paris", "c3")]
        row = state(spark, *rows)["S"]
        assert (row["status"], row["destination"], row["delivered_at"]) == ("DELIVERED", "Berlin", at(9))
        assert len(delivered(spark, *rows)) == 1

    def test_scan_after_delivery(self, spark):
        rows = [("S", "Berlin", at(8), "Berlin", "c1"), ("S", "Somewhere Else", at(9), "Berlin", "c2")]
        row = state(spark, *rows)["S"]
        assert (row["status"], row["last_location"], row["last_scanned_at"]) == ("DELIVERED", "Somewhere Else", at(9))
        assert len(delivered(spark, *rows)) == 1

    def test_every_scan_at_the_destination_delivers(self, spark):
        rows = [("S", "Berlin", at(8), "Berlin", "c1"), ("S", "Berlin", at(9), "Berlin", "c2")]
        assert [r["correlation_id"] for r in delivered(spark, *rows)] == ["c1", "c2"]
        assert state(spark, *rows)["S"]["delivered_at"] == at(9)
        first = lifecycle.delivered_events(replay(spark, *rows), dedupe=True).collect()
        assert [r["correlation_id"] for r in first] == ["c1"]

    def test_padded_location_does_not_deliver(self, spark):
        assert delivered(spark, ("S", "Berlin ", at(8), "Berlin", "c")) == []

    @pytest.mark.parametrize("destination", [None, "", " "])
    def test_without_destination_never_delivered(self, spark, destination):
        rows = [("S", destination, at(8), destination, "c1"), ("S", "Berlin", at(9), "Berlin", "c2")]
        assert state(spark, *rows)["S"]["status"] == "IN_TRANSIT"

    @pytest.mark.parametrize("shipment", [None, "", " ", " "])
    def test_scans_without_shipment_are_skipped(self, spark, shipment):
        assert state(spark, (shipment, "Berlin", at(8), "Berlin", "c")) == {}

    def test_lookups(self, spark):
        states = lifecycle.shipment_state(replay(spark, ("S", "Depot", at(8), "Berlin", "c")))
        asked = table(spark, "shipment_id string", ("S",), ("none",))
        found = lifecycle.status_lookup(asked, states).collect()
        assert sorted(map(tuple, found)) == [("S", "IN_TRANSIT"), ("none", "Unknown")]
        answer = lifecycle.response(lifecycle.shipment_by_id(states, "S")).first()
        assert tuple(answer) == ("S", "IN_TRANSIT", "Depot", None, True, None)
        assert lifecycle.shipment_by_id(states, " S").count() == 0
        for missing in (None, " "):
            with pytest.raises(ValueError, match="shipmentId must not be null or empty"):
                lifecycle.shipment_by_id(states, missing)
            assert lifecycle.shipment_by_id(states, missing, strict=False).count() == 0

    def test_manual_delivery(self, spark):
        states = lifecycle.shipment_state(replay(spark, ("S", "Depot", at(8), "Berlin", "c")))
        rows = [("ok", at(9), ("S", "Paris")), ("none", at(9), None), ("id", at(9), (" ", "Paris")),
                ("place", at(9), ("S", "")), ("unknown", at(9), ("T", "Paris"))]
        requests = spark.createDataFrame(
            rows, "request_id string, requested_at timestamp_ntz, request struct<shipment_id string, location string>"
        )
        marked = lifecycle.mark_delivered(requests, states)
        errors = {r["request_id"]: r["error_message"] for r in marked.collect()}
        assert errors == {
            "ok": None, "none": "Request must not be null", "id": "shipmentId must not be null or empty",
            "place": "location must not be null or empty", "unknown": "Shipment not found: T",
        }
        assert [tuple(r) for r in lifecycle.manual_deliveries(marked).collect()] == [
            ("S", "Berlin", "Paris", at(9), "ok")
        ]
        after = lifecycle.apply_deliveries(states, marked).first()
        assert (after["status"], after["last_location"], after["delivered_at"]) == ("DELIVERED", "Paris", at(9))
        assert after["last_scanned_at"] == at(8)


class TestGate:
    CREATED = "shipment_id string, destination string, created_at timestamp_ntz"
    REQUEST = "request_id string, shipment_id string, location string, scanned_at timestamp_ntz"

    def results(self, spark, created, requests):
        return gate.scan_results(
            table(spark, self.REQUEST, *requests), table(spark, self.CREATED, *created), ["request_id"]
        )

    def test_errors(self, spark):
        requests = [("1", "NON_EXISTENT_ID", "Depot", at(9)), ("2", None, "Depot", at(9)), ("3", "S", None, at(9)),
                    ("4", "S", "", at(9)), ("5", " ", "Depot", at(9)), ("6", "S", "Depot", at(9)),
                    ("7", "S", "Depot", at(7)), ("8", "S", "Depot", at(8))]
        results = self.results(spark, [("S", "Berlin", at(8))], requests)
        assert {r["request_id"]: r["error_message"] for r in results.collect()} == {
            "1": "Shipment with ID NON_EXISTENT_ID not found.", "2": "Shipment ID cannot be null",
            "3": "Location cannot be null", "4": "Location cannot be empty",
            "5": "Shipment with ID   not found.", "6": None, "7": "Shipment with ID S not found.", "8": None,
        }
        assert gate.scan_rejected(results).count() == 3
        accepted = gate.scan_accepted(results).collect()
        assert sorted(r["correlation_id"] for r in accepted) == ["6", "8"]
        assert {r["destination"] for r in accepted} == {"Berlin"}

    def test_a_repeated_create_resets(self, spark):
        created = [("S", "Berlin", at(8)), ("S", "Paris", at(10)), ("T", "Rome", at(8))]
        requests = [("1", "S", "A", at(9)), ("2", "S", "B", at(11)), ("3", "T", "C", at(9)), ("4", "U", "D", at(9))]
        destinations = {r["request_id"]: r["destination"] for r in self.results(spark, created, requests).collect()}
        assert destinations == {"1": "Berlin", "2": "Paris", "3": "Rome", "4": None}

        def state(*rows):
            found = gate.scan_state(table(spark, self.REQUEST, *rows), table(spark, self.CREATED, *created), ["request_id"])
            return {r["shipment_id"]: (r["destination"], r["last_location"], r["status"]) for r in found.collect()}

        assert state(*requests) == {"S": ("Paris", "B", "IN_TRANSIT"), "T": ("Rome", "C", "IN_TRANSIT")}
        assert state(requests[0])["S"] == ("Paris", None, "CREATED")

    def test_known_check(self, spark):
        known = gate.known_shipments(table(spark, self.CREATED, ("S-1", "Berlin", at(8)), ("a b", "Rome", at(8))))
        asked = table(spark, "shipment_id string", ("S-1",), ("S-2",), ("a b",), ("S-1\n",), ("",))
        found = {r["shipment_id"]: (r["valid_id"], r["known"]) for r in gate.scan_known_check(asked, known).collect()}
        assert found == {"S-1": (True, True), "S-2": (True, False), "a b": (False, False),
                         "S-1\n": (False, False), "": (False, False)}


class TestCreation:
    def test_blank_fields(self, spark):
        rows = [("1", "", "Vienna", "c", DAY), ("2", "Berlin", " ", None, DAY), ("3", "Berlin", "Vienna", "\t", DAY),
                ("4", "Berlin", "Vienna", "c", DAY)]
        requests = table(spark, "request_id string, origin string, destination string, customer_id string, "
                         "requested_at timestamp_ntz", *rows)
        errors = {r["request_id"]: r["error_message"] for r in creation.create_validation(requests).collect()}
        assert errors == {"1": "Origin must not be blank", "2": "Destination must not be blank",
                          "3": "CustomerId must not be blank", "4": None}
        made = creation.create_shipments(requests).first()
        assert len(made["shipment_id"]) == 64
        assert (made["status"], made["created_at"]) == ("CREATED", DAY)
        assert creation.created_events(creation.create_shipments(requests)).columns == [
            "shipment_id", "destination", "created_at", "correlation_id"]


class TestNotifications:
    EVENT = ("event_type string, shipment_id string, destination string, location string, "
             "event_at timestamp_ntz, correlation_id string, record_id string")

    def stream(self, spark, *rows):
        return table(spark, self.EVENT, *rows)

    def life(self, spark):
        return self.stream(
            spark,
            (S.CREATED_EVENT, "SHIP-123", "Berlin", None, at(10), "c", "r1"),
            (S.SCANNED_EVENT, "SHIP-123", "Berlin", "Depot", at(10, 30), "c", "r2"),
            (S.DELIVERED_EVENT, "SHIP-456", "Berlin", "Berlin Mitte", at(12), "c", "r3"),
        )

    def test_one_of_each_type(self, spark):
        notes = notify.notifications(self.life(spark))
        messages = {r["type"]: r["message"] for r in notes.collect()}
        assert messages == {
            "SHIPMENT_CREATED": "Shipment SHIP-123 has been created and is being prepared for transport to Berlin.",
            "SHIPMENT_SCANNED": "Shipment SHIP-123 has been scanned at Depot. Current destination: Berlin.",
            "SHIPMENT_DELIVERED": "Shipment SHIP-456 has been successfully delivered to Berlin Mitte.",
        }
        assert notify.notifications_for_shipment(notes, " SHIP-123 ").count() == 2
        assert notify.notifications_for_shipment(notes, " ").count() == 0
        assert notify.notification_by_id(notes, None).count() == 0
        latest = notify.recent_notifications(notes, 2).collect()
        assert [r["timestamp"] for r in latest] == [at(12), at(10, 30)]
        assert {r["id"] for r in notes.collect()} == {r["id"] for r in notify.notifications(self.life(spark)).collect()}

    def test_three_streams_make_the_same(self, spark):
        one = self.life(spark)

        def of(event_type, time):
            return one.filter(F.col("event_type") == event_type).withColumnRenamed("event_at", time)

        joined = events.event_stream(
            of(S.CREATED_EVENT, "created_at"), of(S.SCANNED_EVENT, "scanned_at"), of(S.DELIVERED_EVENT, "delivered_at")
        )
        assert joined.exceptAll(one).count() == 0 and joined.count() == 3

    def test_unusable_events_are_dropped(self, spark):
        rows = [(S.CREATED_EVENT, x, "Berlin", None, at(10), "c", "r") for x in (None, "", " ")]
        assert notify.notifications(self.stream(spark, *rows)).count() == 0

    def test_null_fields_print_as_null(self, spark):
        row = notify.notifications(self.stream(spark, (S.CREATED_EVENT, "S", None, None, at(10), "c", "r"))).first()
        assert row["message"].endswith("transport to null.")

    def test_counts(self, spark):
        notes = notify.notifications(self.life(spark)).filter("type <> 'SHIPMENT_CREATED'")
        by_type = {r["type"]: r["count"] for r in notify.notifications_by_type(notes).collect()}
        assert by_type == {"SHIPMENT_CREATED": 0, "SHIPMENT_SCANNED": 1, "SHIPMENT_DELIVERED": 1}
        assert notify.notifications_by_shipment(notes, top_n=1).first()["shipment_id"] == "SHIP-123"

    def test_validation(self, spark):
        rows = [("1", " ", "m", "t"), ("2", "s", None, "t"), ("3", "s", "m", None), ("4", "s", "m", "t")]
        notes = table(spark, "id string, shipment_id string, message string, type string", *rows)
        found = notes.select("id", validate.notification_error(absent=F.col("id") == "4").alias("e")).collect()
        assert [r["e"] for r in sorted(found)] == [
            "Notification shipmentId must not be null or empty", "Notification message must not be null or empty",
            "Notification type must not be null", "Notification must not be null"]

    def test_deletion(self, spark):
        notes = notify.notifications(self.life(spark))
        first = notes.orderBy("timestamp").first()["id"]
        gone = table(spark, "request_id int, id string", (1, f" {first}"), (2, "x"), (3, " "), (4, None))
        assert notify.delete_notifications(notes, gone).count() == 2
        assert tuple(notify.deletion_counts(notes, gone).first()) == (1, 2)
        assert tuple(notify.deletion_counts(notes).first()) == (3, 0)
        answers = {r["id"]: r["error_message"] for r in notify.deletion_results(notes, gone).collect()}
        assert answers == {f" {first}": None, "x": "Notification not found with ID: x",
                           " ": "Notification ID must not be null or empty",
                           None: "Notification ID must not be null or empty"}

    def test_an_id_is_deleted_once(self, spark):
        notes = notify.notifications(self.life(spark))
        first = notes.orderBy("timestamp").first()["id"]
        again = table(spark, "request_id int, id string", (2, first), (1, f"{first} "), (3, first))
        answers = {r["request_id"]: r["success"] for r in notify.deletion_results(notes, again).collect()}
        assert answers == {1: True, 2: False, 3: False}
        assert tuple(notify.deletion_counts(notes, again).first()) == (1, 2)

    def test_webhook_and_customer_messages(self, spark):
        payloads = records.webhook_payloads(self.life(spark))
        by_type = {r["eventType"]: r for r in payloads.collect()}
        assert by_type["shipment-scanned"]["origin"] == "Depot"
        assert by_type["shipment-delivered"]["destination"] == "Berlin Mitte"
        assert by_type["shipment-delivered"]["origin"] is None
        assert by_type["shipment-created"]["customerId"] == "CUSTOMER-123"
        now = F.lit(at(13)).cast("timestamp_ntz")
        sent = {r["event_type"]: r for r in records.customer_messages(payloads, "Acme", now).collect()}
        assert sent["shipment-created"]["sms"] == "🐾 Acme: Sendung SHIP-123 → Berlin"
        assert sent["shipment-delivered"]["execution_time"] == 3_600_000
        assert sent["shipment-scanned"]["customer_name"] == "Demo Kunde 123"

    def test_event_metrics(self, spark):
        bodies = table(spark, "body string", ('{"eventType":"a"}',), ('{"eventType":"a"}',), ("{",), (None,), ("",))
        found = {tuple(r) for r in records.event_metrics(bodies).collect()}
        assert found == {("a", "success", 2), ("error", "failure", 3)}


def test_full_workflow(spark):
    """Create, scan at the origin, scan at the destination: delivered, four notifications."""
    created = table(spark, "shipment_id string, destination string, created_at timestamp_ntz, correlation_id string, "
                    "record_id string", ("S", "Vienna", at(8), "c0", "created:0:0"))
    requests = table(spark, TestGate.REQUEST, ("r1", "S", "Berlin", at(9)), ("r2", "S", "Vienna", at(10)))
    accepted = gate.scan_accepted(gate.scan_results(requests, created, ["request_id"]))
    accepted = accepted.withColumn("record_id", F.concat_ws(":", F.lit("scanned"), "correlation_id"))
    replayed = lifecycle.replay(accepted, ["scanned_at", "correlation_id"], [F.col("scanned_at")])
    assert lifecycle.shipment_state(replayed).first()["status"] == "DELIVERED"
    stream = events.created_events(created).unionByName(events.replayed_events(replayed))
    kinds = [r["type"] for r in notify.notifications(stream).orderBy("timestamp", "type").collect()]
    assert sorted(kinds) == ["SHIPMENT_CREATED", "SHIPMENT_DELIVERED", "SHIPMENT_SCANNED", "SHIPMENT_SCANNED"]
    hourly = counts.delivery_counts(lifecycle.delivered_events(replayed)).collect()
    assert [tuple(r) for r in hourly] == [("Vienna", at(10), at(11), 1)]


def test_early_requests_are_the_rejected_ones(spark):
    """One join gives what the replay gives, nulls, blanks and repeated creates included."""
    def at(minute):
        return None if minute is None else datetime(2024, 1, 15, 10) + timedelta(minutes=minute)

    creates = [("A", 5), ("A", 2), ("B", 7), ("C", None), ("C", 9), (None, 1)]
    asked = [
        (f"{s}-{m}", s, place, at(m))
        for s in ("A", "B", "C", "D", " ", None) for m in (None, 0, 2, 7, 8) for place in ("Hub", " ", None)
    ]
    for extra in ([], [(" ", 3)]):
        created = spark.createDataFrame([(s, "Berlin", at(m)) for s, m in creates + extra], "shipment_id string, destination string, created_at timestamp_ntz")
        requests = spark.createDataFrame(asked, "request_id string, shipment_id string, location string, scanned_at timestamp_ntz")
        slow = gate.scan_rejected(gate.scan_results(requests, created, ["request_id"]))
        fast = gate.early_requests(requests, created)
        assert fast.columns == slow.columns
        assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect())) != []
