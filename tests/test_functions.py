"""Expressions on their edge cases, independent of the session's time zone."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waybill.functions import text, times
from waybill.sources import decode, logs, tables


def value(spark, column, **inputs):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or [F.lit(1)])
    return df.select(column).first()[0]


def ntz(moment):
    return F.lit(moment).cast("timestamp_ntz")


@pytest.fixture(params=["UTC", "America/New_York", "Europe/Berlin"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2024-01-15T10:30:00", datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15T10:30", datetime(2024, 1, 15, 10, 30)),
        (" 2024-01-15T10:30:05.25 ", datetime(2024, 1, 15, 10, 30, 5, 250000)),
        ("2024-03-31T02:30:00", datetime(2024, 3, 31, 2, 30)),
        ("[2024,1,15,10,30]", datetime(2024, 1, 15, 10, 30)),
        ("[2024, 1, 15, 10, 30, 5]", datetime(2024, 1, 15, 10, 30, 5)),
        ("[2024,12,5,0,0,59,7000]", datetime(2024, 12, 5, 0, 0, 59, 7)),
        ("[2024,1,15,10,30,0,250000000]", datetime(2024, 1, 15, 10, 30, 0, 250000)),
        ("[2024,1,15,10]", None),
        ("[2024,13,15,10,30]", None),
        ("[2024,2,30,10,30]", None),
        ("2024-02-30T10:30:00", None),
        ("2024", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_read_datetime(spark, raw, expected):
    assert value(spark, times.read_datetime("x"), x=raw) == expected


@pytest.mark.parametrize(
    "moment, iso, array",
    [
        ("2024-01-15 10:30:00", "2024-01-15T10:30:00", "[2024,1,15,10,30]"),
        ("2024-01-15 00:00:00", "2024-01-15T00:00:00", "[2024,1,15,0,0]"),
        ("2024-01-15 10:30:07.5", "2024-01-15T10:30:07.5", "[2024,1,15,10,30,7,500000000]"),
        ("2024-03-31 02:30:07", "2024-03-31T02:30:07", "[2024,3,31,2,30,7]"),
        ("1969-12-31 23:59:59.000001", "1969-12-31T23:59:59.000001", "[1969,12,31,23,59,59,1000]"),
    ],
)
def test_written_dates_read_back(spark, zone, moment, iso, array):
    assert value(spark, times.iso_datetime(ntz(moment))) == iso
    assert value(spark, F.to_json(times.datetime_array(ntz(moment)))) == array
    for written in (iso, array):
        assert value(spark, times.read_datetime("x") == ntz(moment), x=written)
    assert value(spark, times.from_instant(times.to_instant(ntz(moment))) == ntz(moment))


def test_epoch_millis(spark, zone):
    assert value(spark, times.epoch_millis(ntz("2024-07-15 10:00:00"))) == 1721037600000


@pytest.mark.parametrize(
    "zone_name, local, utc",
    [
        ("Europe/Berlin", "2024-01-15 10:30:00", datetime(2024, 1, 15, 9, 30)),
        ("Europe/Berlin", "2024-07-15 10:30:00", datetime(2024, 7, 15, 8, 30)),
        ("Europe/Berlin", "2024-03-31 02:30:00", datetime(2024, 3, 31, 1, 30)),
        ("Europe/Berlin", "2024-10-27 02:30:00", datetime(2024, 10, 27, 0, 30)),
        ("UTC", "2024-01-15 10:30:00", datetime(2024, 1, 15, 10, 30)),
        ("Nowhere/Land", "2024-01-15 10:30:00", datetime(2024, 1, 15, 10, 30)),
        (None, "2024-01-15 10:30:00", datetime(2024, 1, 15, 10, 30)),
    ],
)
def test_event_time(spark, zone, zone_name, local, utc):
    assert value(spark, times.event_time(ntz(local), zone=zone_name)) == utc


def test_event_time_falls_back(spark):
    none, record, now = ntz(None), ntz("2024-01-01 00:00:00"), ntz("2024-02-02 00:00:00")
    assert value(spark, times.event_time(none, record, now)) == datetime(2024, 1, 1)
    assert value(spark, times.event_time(none, times.epoch(), now)) == datetime(2024, 2, 2)
    assert value(spark, times.event_time(none, none, now)) == datetime(2024, 2, 2)
    assert value(spark, times.event_time(none)) > datetime(2024, 1, 1)


def test_clock_display(spark, zone):
    assert value(spark, times.clock_display(ntz("2024-03-31 02:30:00"))) == "Mar 31 02:30"
    assert value(spark, times.clock_display(ntz(None))) == "N/A"


BLANKS = [None, "", " ", "\t\r\n", " ", "　", " ", "\x1c"]
NOT_BLANK = ["a", " ", " ", " ", " a ", "\x00"]


@pytest.mark.parametrize("raw", BLANKS)
def test_blank(spark, raw):
    assert value(spark, text.is_blank("x"), x=raw)


@pytest.mark.parametrize("raw", NOT_BLANK)
def test_not_blank(spark, raw):
    assert not value(spark, text.is_blank("x"), x=raw)


def test_trimmed(spark):
    assert value(spark, text.trimmed("x"), x="\x00\t a b \x1f\n") == "a b"
    assert value(spark, text.trimmed("x"), x=" a ") == " a "
    assert value(spark, text.is_empty("x"), x="\x00 ") and not value(spark, text.is_empty("x"), x=" ")


def test_preview(spark):
    assert value(spark, text.preview("x"), x="a" * 50) == "a" * 50
    assert value(spark, text.preview("x"), x="a" * 51) == "a" * 50 + "..."
    assert value(spark, text.preview("x"), x=None) is None


def records(spark, *rows):
    fields = "topic string, value string, type_id string"
    df = spark.createDataFrame(list(rows), fields)
    return df.select(
        "topic", F.lit(1).alias("partition"), F.monotonically_increasing_id().alias("offset"),
        ntz("2024-01-01 00:00:00").alias("timestamp"), "type_id", F.lit("k").alias("key"), "value",
    )


def test_types_and_reasons(spark):
    topic = "shipment-delivered"
    rows = records(
        spark,
        (topic, '{"shipmentId":"by topic","location":"L","createdAt":"x"}', None),
        (topic, '{"shipmentId":"by name","eventType":"ShipmentScannedEvent","deliveredAt":"x"}', None),
        (topic, '{"shipmentId":"by header","eventType":"ShipmentScannedEvent"}', "a.b.ShipmentCreatedEvent"),
        (topic, '{"shipmentId":"foreign"}', "a.b.Other"),
        ("elsewhere", '{"shipmentId":"no type"}', None),
        (topic, '{"shipmentId":"date","deliveredAt":[2024,1]}', None),
        (topic, '{"shipmentId":', None),
        (topic, "", None),
        (topic, None, None),
        (topic, '{"shipmentId":"late","deliveredAt":[2024,1,15,10,30],"version":"v7","timestamp":"2024-05-05T01:02:03Z"}', None),
    )
    parsed = decode.parse(rows)
    typed = {r["shipment_id"]: r for r in decode.typed(parsed).collect()}
    assert {k: r["event_type"] for k, r in typed.items()} == {
        "by topic": "ShipmentDeliveredEvent", "by name": "ShipmentScannedEvent",
        "by header": "ShipmentCreatedEvent", "late": "ShipmentDeliveredEvent",
    }
    assert typed["by topic"]["version"] == "v1"
    assert typed["by topic"]["timestamp"] == datetime(2024, 1, 1)
    assert typed["late"]["delivered_at"] == datetime(2024, 1, 15, 10, 30)
    assert (typed["late"]["version"], typed["late"]["timestamp"]) == ("v7", datetime(2024, 5, 5, 1, 2, 3))
    reasons = sorted(r["reason"] for r in decode.dead_letters(parsed).collect())
    assert reasons == ["malformed JSON"] * 2 + ["unknown event type"] * 2 + ["unreadable date"]


def test_log_files(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        "2024-01-15 10:30:00 [main] ERROR a.b.C - it broke\n"
        "2024-01-15 10:30:01 [main] INFO  a.b.C - fine\n"
        "java.lang.IllegalStateError: trace\n"
    )
    (tmp_path / "b.log").write_text("2024-01-15 10:30:02 [t-1] WARN  x - no Error here\n")
    lines = logs.read_logs(spark, {"a": str(tmp_path / "a.log"), "b": str(tmp_path / "b.log")})
    found = sorted(map(tuple, logs.error_log_lines(lines).collect()), key=repr)
    assert found == [
        ("a", None, None, None, None, "java.lang.IllegalStateError: trace"),
        ("a", datetime(2024, 1, 15, 10, 30), "main", "ERROR", "a.b.C", "it broke"),
        ("b", datetime(2024, 1, 15, 10, 30, 2), "t-1", "WARN", "x", "no Error here"),
    ]


def test_hash_free_ids_repeat(spark, sf_dir):
    one = tables.scans(spark, sf_dir).select("record_id")
    assert one.distinct().count() == one.count()
