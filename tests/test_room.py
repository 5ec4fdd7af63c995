"""What travels between tasks: numbers rather than texts, and each row once."""

import pytest
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import notify
from waybill.plans import catalog
from waybill.plans import notifications as plans
from waybill.sources import stored, tables


@pytest.fixture
def unbroadcast(spark):
    """Nothing is small enough but what the code itself has sized."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(spark, sf_dir, name):
    return catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def same(left, right):
    left = left.select(*right.columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def below(text, operator):
    """The plan under the first operator of that name, without what is beside it."""
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if operator in line)
    indent = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    under = []
    for line, depth in zip(lines[at + 1:], indent[at + 1:]):
        if depth <= indent[at]:
            break
        under.append(line)
    return "\n".join(under)


@pytest.mark.parametrize("name", ["shipment_state", "notifications_by_shipment"])
def test_scans_are_shuffled_once_where_suppliers_are_small(spark, small_dir, name):
    """Each small table is below the limit; the size guessed for a join of two isn't."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10KB")
    try:
        text = plan(spark, small_dir, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    placed = [line for line in text.split("\n") if "Exchange hashpartitioning(" in line]
    assert placed and all("hashpartitioning(shipment_id" in line for line in placed), placed


@pytest.mark.parametrize("name", ["notifications", "notification_sent_records", "deletion_counts"])
def test_ids_are_made_after_the_replay(spark, small_dir, name):
    text = plan(spark, small_dir, name)
    assert S.TOPIC_SCANNED in text
    assert S.TOPIC_SCANNED not in below(text, "Window [")


@pytest.mark.parametrize("name", ["notifications_by_shipment", "busiest_shipments"])
def test_counts_make_no_ids_and_hold_no_delivery(spark, small_dir, name):
    text = plan(spark, small_dir, name)
    assert "concat_ws" not in text
    assert "last_value" not in text and "last(" not in text


def test_the_table_by_shipment_is_written_once(spark, small_dir, monkeypatch):
    def twice(rows):
        raise AssertionError("written to learn its size")

    monkeypatch.setattr(stored, "_made", {})
    monkeypatch.setattr(stored, "materialise", twice)
    table = plans._stored(spark, small_dir)
    same(table.drop("buckets", "bucket"), plans.notifications(spark, small_dir))
    assert all(".zstd." in f for f in table.inputFiles())


def test_how_many_buckets_follows_the_rows(spark, small_dir, monkeypatch):
    assert plans._buckets(spark, small_dir) == stored.FEWEST
    monkeypatch.setattr(stored, "BUCKET_BYTES", 4096)
    rows = tables.order_ids(spark, small_dir).count() + tables.scan_keys(spark, small_dir).count()
    assert plans._buckets(spark, small_dir) == -(-rows * stored.NOTE_BYTES // 4096)


def test_the_table_by_day_needs_no_other(spark, small_dir, monkeypatch):
    def other(*_):
        raise AssertionError("shuffled texts")

    monkeypatch.setattr(stored, "_made", {})
    monkeypatch.setattr(plans, "_stored", other)
    same(
        plans.recent_notifications_stored(spark, small_dir),
        notify.recent_notifications(plans.notifications(spark, small_dir)),
    )


def test_moved_rows_make_the_same_tables(spark, small_dir, tmp_path):
    """Rows without a time too."""
    rows = plans._usable(spark, small_dir).withColumn(
        "timestamp", F.when(F.col("shipment_id").cast("bigint") % 5 != 0, F.col("timestamp"))
    )
    want = plans._made(rows)
    stored.write_notifications(rows, str(tmp_path / "shipments"), 4, make=plans._made)
    table = spark.read.parquet(str(tmp_path / "shipments"))
    same(table.drop("buckets", "bucket"), want)
    one = notify.notifications_for_shipment(stored.notifications_of(table, "42"), "42")
    same(one, want.filter("shipment_id = '42'"))
    stored.write_by_day(rows, str(tmp_path / "days"), make=plans._made)
    same(spark.read.parquet(str(tmp_path / "days")).drop("day"), want)


HASH = "0123456789abcdef" * 4
ODD = [HASH, HASH.upper(), HASH[1:], HASH + "0", HASH + "\n", "00" + HASH, "x", "é", "\x00", "\x01", "", "0" * 64, " ", None]


def test_packed_ids_differ_as_ids_do(spark):
    rows = spark.createDataFrame([(i,) for i in ODD], "id string")
    packed = rows.select("id", notify._packed(F.col("id")).alias("k"))
    assert {r["id"]: r["back"] for r in packed.select("id", notify._unpacked(F.col("k")).alias("back")).collect()} == {i: i for i in ODD}
    assert packed.filter("k IS NOT NULL").select("k").distinct().count() == len(ODD) - 1
    assert packed.filter(F.col("id") == HASH).select(F.octet_length("k")).first()[0] == 33


def test_deletions_by_any_id(spark, unbroadcast):
    """Notifications without an id stay; ids come back as they were, twice if they were."""
    notes = spark.createDataFrame([(n, i) for n, i in enumerate([*ODD, "x"])], "n int, id string")
    gone = spark.createDataFrame([(1, f" {HASH}"), (2, "x"), (3, "missing"), (4, None), (5, " "), (6, HASH.upper()), (7, "x ")], "request_id int, id string")
    kept = notify.delete_notifications(notes, gone)
    assert kept.columns == ["id", "n"]
    assert sorted((r["n"], r["id"]) for r in kept.collect()) == sorted((n, i) for n, i in enumerate([*ODD, "x"]) if i not in (HASH, "x", HASH.upper()))
    assert tuple(notify.deletion_counts(notes, gone).first()) == (4, len(ODD) + 1 - 4)
    answers = {r["request_id"]: r["success"] for r in notify.deletion_results(notes, gone).collect()}
    assert answers == {1: True, 2: True, 3: False, 4: False, 5: False, 6: True, 7: False}


@pytest.mark.parametrize("name, join", [("deletion_results", "LeftSemi"), ("deletion_counts", "LeftOuter"), ("delete_notifications", "LeftAnti")])
def test_ids_travel_packed(spark, small_dir, unbroadcast, name, join):
    """And texts not at all."""
    text = plan(spark, small_dir, name)
    line = next(line for line in text.split("\n") if join in line)
    assert "wanted" in line
    side = below(text, join)
    assert "unhex" in side and "has been" not in side
