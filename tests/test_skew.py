"""One shipment with a third of all scans: the split plan against the plain one."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waybill.operators import gate, late, lifecycle, skew
from waybill.operators.skew import FIRST, HotKeys, Running, sized_broadcast, with_running
from waybill.sources import tables

EAGER = HotKeys(slots=4096, factor=8, floor_rows=100)
NEVER = HotKeys(floor_rows=10**12)


def hot_scans(spark, sf_dir):
    scans = tables.scans(spark, sf_dir)
    third = F.col("part") % 3 == 0
    return scans.withColumn("shipment_id", F.when(third, F.lit("HOT")).otherwise(F.col("shipment_id")))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(left, right):
    left = left.select(*right.columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def test_finds_the_hot_key_and_only_bounded_many(spark, small_dir):
    keys = hot_scans(spark, small_dir).select("shipment_id")
    hot = EAGER.find(keys, "shipment_id")
    expected = spark.range(1).select(F.lit("HOT").alias("k")).select(EAGER.slot("k")).first()[0]
    assert expected in hot
    assert len(hot) <= EAGER.slots / EAGER.factor
    assert HotKeys().find(keys, "shipment_id") == []
    assert EAGER.find(keys.limit(0), "shipment_id") == []


@pytest.mark.parametrize("prepared", [False, True])
def test_replay_of_a_hot_shipment(spark, small_dir, prepared):
    scans = hot_scans(spark, small_dir)
    if prepared:
        scans = scans.repartition(4, "shipment_id")
    split = lifecycle.replay(scans, tables.SCAN_ORDER, tables.scan_chunk(), hot=EAGER)
    plain = lifecycle.replay(scans, tables.SCAN_ORDER, tables.scan_chunk(), hot=NEVER)
    assert "_chunk" in plan_of(split) and "_chunk" not in plan_of(plain)
    # the big side is placed by shipment and chunk, never by shipment alone, before its windows
    assert "hashpartitioning(shipment_id" in plan_of(split)
    same(split, plain)
    same(lifecycle.shipment_state(split), lifecycle.shipment_state(plain))
    same(lifecycle.delivered_events(split, True), lifecycle.delivered_events(plain, True))


def test_the_hot_rows_spread_over_tasks(spark, small_dir):
    scans = hot_scans(spark, small_dir).repartition(8, "shipment_id")
    counted = with_running(
        scans, "shipment_id", tables.SCAN_ORDER, tables.scan_chunk(), [Running("seq", "count")], hot=EAGER
    )
    placed = counted.filter("shipment_id = 'HOT'")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = placed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    counts = [r["count"] for r in tasks]
    assert len(counts) > 1 and max(counts) < sum(counts) * 0.8


def test_scan_gate_with_a_hot_shipment(spark, small_dir):
    requests = tables.scan_requests(spark, small_dir)
    third = F.col("part") % 3 == 0
    requests = requests.withColumn(
        "shipment_id", F.when(third, F.lit("42")).otherwise(F.col("shipment_id"))
    )
    created = tables.recreated(spark, small_dir)
    answers = [
        gate.scan_results(requests, created, tables.SCAN_ORDER, hot=hot) for hot in (EAGER, NEVER)
    ]
    assert "_chunk" in plan_of(answers[0])
    same(*answers)


def test_chunks_depend_on_rows_not_on_the_grain_of_time(spark):
    rows = spark.range(4000).select(
        F.lit("HOT").alias("k"),
        F.timestamp_add("MICROSECOND", F.col("id") * 7 % 4000, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("at"),
        F.col("id"),
    )
    hot = HotKeys(slots=16, factor=0, floor_rows=1000)
    split = with_running(rows, "k", ["at", "id"], [F.col("at")], [Running("n", "count")], hot=hot)
    same(split, with_running(rows, "k", ["at", "id"], [F.col("at")], [Running("n", "count")], hot=NEVER))
    chunks = skew._chunked(rows, "k", [F.col("at")], 16).select("_chunk").distinct().count()
    assert 8 <= chunks <= 2 * 16


def test_one_moment_with_many_rows_is_cut_by_the_rest(spark):
    rows = spark.range(1000).select(F.lit("HOT").alias("k"), F.lit(5).alias("day"), F.col("id"))
    chunk = [F.col("day"), F.floor(F.col("id") / 100)]
    hot = HotKeys(slots=16, factor=0, floor_rows=100)
    split = with_running(rows, "k", ["day", "id"], chunk, [Running("n", "count")], hot=hot)
    same(split, with_running(rows, "k", ["day", "id"], chunk, [Running("n", "count")], hot=NEVER))
    assert skew._chunked(rows, "k", chunk, 8).select("_chunk").distinct().count() == 10


def test_running_values_over_nulls(spark):
    rows = [("a", i, None if i % 3 == 0 else i, None if i < 40 else -i) for i in range(90)]
    rows += [("b", i, i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, o int, v int, w int")
    values = [
        Running("n", "count"),
        Running("l", "last", F.col("v")),
        Running("m", "max", F.col("w")),
        Running("d", "last", F.col("o") - F.coalesce(F.col(FIRST), F.lit(100))),
    ]

    def run(hot):
        chunk = [F.floor(F.col("o") / 7)]
        return with_running(df, "k", ["o"], chunk, values, F.col("v"), hot).withColumnRenamed(FIRST, "f")

    split = run(HotKeys(slots=16, factor=0, floor_rows=10))
    same(split, run(NEVER))
    at = {r["o"]: r for r in split.filter("k = 'a'").collect()}
    assert [at[0][c] for c in "nflmd"] == [1, None, None, None, -100]
    assert [at[63][c] for c in "nflmd"] == [64, None, 62, -40, -37]


def test_sized_broadcast(spark):
    small = spark.range(10)
    big = spark.range(1000)
    joined = "BroadcastHashJoin"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert joined in plan_of(big.join(sized_broadcast(small, 10), "id"))
        assert joined not in plan_of(big.join(sized_broadcast(small, 9), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


ORDER = ["arrival", "event_id"]


def brute_force(rows, size, slide, grace, clock):
    """Late (event, window) pairs by walking the arrivals one by one."""
    found, clocks = set(), {}
    for r in sorted(rows, key=lambda r: (r["arrival"], r["event_id"])):
        scope = clock(r)
        clocks[scope] = max(clocks.get(scope, r["delivered_at"]), r["delivered_at"])
        since = r["delivered_at"] - datetime(1970, 1, 1)
        start = datetime(1970, 1, 1) + (since // slide) * slide
        while start + size > r["delivered_at"]:
            if start + size + grace <= clocks[scope]:
                found.add((r["event_id"], start))
            start -= slide
    return found


@pytest.mark.parametrize("clock", [["location"], []])
@pytest.mark.parametrize("slide", [60, 20])
@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_lateness_against_brute_force(spark, clock, slide, broadcast_rows):
    events = tables.late_arrivals(spark, "/root/testdata/sf0.001")
    got = late.late_deliveries(
        events, ORDER, clock=clock, slide=f"{slide} minutes", grace="7 minutes", broadcast_rows=broadcast_rows
    )
    minutes = timedelta(minutes=1)
    want = brute_force(
        events.collect(), 60 * minutes, slide * minutes, 7 * minutes,
        (lambda r: r["location"]) if clock else (lambda r: None),
    )
    assert {(r["event_id"], r["window_start"]) for r in got.collect()} == want
    assert want
