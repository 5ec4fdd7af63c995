"""What the plans look like: columns and filters at the scan, few shuffles, no Python."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F
from waybill.operators import notify
from waybill.plans import catalog, oracle
from waybill.sources import decode, stored, tables


def plan(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_two_columns_and_shuffles_once(spark, sf_dir):
    text = plan(spark, sf_dir, "delivery_counts_hourly")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert text.count("Exchange ") == 1
    assert text.count("HashAggregate") == 2


def pushed(text):
    return [line.strip() for line in re.findall(r"PushedFilters: (\[[^\n]*)", text)]


@pytest.mark.parametrize("name", ["counts_in_range", "location_analytics"])
def test_ranges_reach_the_scan(spark, sf_dir, name):
    found = pushed(plan(spark, sf_dir, name))
    assert any("GreaterThanOrEqual(ts,2024-01-" in f and "LessThan(ts,2024-01-" in f for f in found), found


@pytest.mark.parametrize("name", ["counts_last_24h", "recent_window_count"])
def test_a_range_up_to_the_newest_reaches_the_scan(spark, sf_dir, name):
    found = pushed(plan(spark, sf_dir, name))
    assert any("GreaterThanOrEqual(ts," in f and "LessThan(ts," in f for f in found), found


def test_a_location_reaches_the_scan(spark, sf_dir):
    assert any("StringContains(event_type,purchase)" in f for f in pushed(plan(spark, sf_dir, "location_analytics")))


@pytest.mark.parametrize("name", ["shipment_by_id", "notifications_for_shipment"])
def test_a_shipment_reaches_the_scan(spark, sf_dir, name):
    assert any("EqualTo(l_orderkey,42)" in f for f in pushed(plan(spark, sf_dir, name)))


def test_metadata_of_records_reaches_the_scan(spark, small_dir, tmp_path):
    tables.delivered_records(spark, small_dir).write.parquet(str(tmp_path / "records"))
    records = spark.read.parquet(str(tmp_path / "records"))
    rows = decode.decode(records, where="partition = 1 and offset < 10")
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert any("EqualTo(partition,1)" in f and "LessThan(offset,10)" in f for f in pushed(text))
    assert rows.count() == decode.decode(records).filter("partition = 1 and offset < 10").count() == 10


def test_stored_counts_are_pruned_by_day(spark, sf_dir):
    text = plan(spark, sf_dir, "counts_in_range_stored")
    assert "PartitionFilters: [isnotnull(day" in text and "2024-01-10" in text


def scanned_rows(df):
    """Rows that the scans of an executed query gave out, before any filter above them."""
    df.collect()
    done = df._jdf.queryExecution().executedPlan()
    if done.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        done = done.executedPlan()
    leaves = done.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_stored_notifications_are_pruned_by_shipment(spark, sf_dir):
    text = plan(spark, sf_dir, "notifications_for_shipment_stored")
    assert "PartitionFilters: [isnotnull(bucket" in text
    assert any("EqualTo(shipment_id,42)" in f for f in pushed(text))


def test_an_id_skips_row_groups(spark, tmp_path):
    """Ids are hashes, so only their Bloom filters tell where one can be."""
    notes = spark.range(40_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"), F.col("id").cast("string").alias("shipment_id"),
        F.lit("x").alias("type"), F.lit("y").alias("message"), F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"),
    )
    stored.write_notifications(notes, str(tmp_path / "notes"), buckets=16)
    table = spark.read.parquet(str(tmp_path / "notes")).drop("buckets", "bucket")
    wanted = notes.filter("shipment_id = '777'").first()["id"]
    found = notify.notification_by_id(table, wanted)
    assert [r["shipment_id"] for r in found.collect()] == ["777"]
    assert scanned_rows(found) <= 3 * 40_000 / 16


def test_how_many_buckets_follows_the_size(spark, tmp_path, monkeypatch):
    notes = spark.range(5000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit("busy").alias("shipment_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"),
    )
    monkeypatch.setattr(stored, "BUCKET_BYTES", 4096)
    stored.write_notifications(notes, str(tmp_path / "notes"))
    table = spark.read.parquet(str(tmp_path / "notes"))
    assert table.select("buckets").first()["buckets"] > stored.FEWEST
    assert stored.notifications_of(table, " busy ").count() == 5000


def test_stored_state_joins_without_a_shuffle(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, sf_dir, "status_lookup_stored")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1  # the requests
    text = plan(spark, sf_dir, "shipment_by_id_stored")
    assert "Bucketed: " in text and any("EqualTo(shipment_id,42)" in f for f in pushed(text))


def test_the_newest_come_from_the_newest_days(spark, tmp_path):
    """Equal to the full sort, with ties over a day's edge; older folders aren't read."""
    notes = spark.range(300).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.expr("timestamp_ntz'2024-01-10 00:00:00' - make_dt_interval(int(id div 40) div 2, 0, 0, 0) "
               "- make_dt_interval(0, 0, 0, int(id div 40) % 2)").alias("timestamp"),
    )
    stored.write_by_day(notes.unionByName(notes.limit(1).select("id", F.lit(None).cast("timestamp_ntz").alias("timestamp"))), str(tmp_path / "days"))
    table = spark.read.parquet(str(tmp_path / "days"))
    for limit in (5, 45, 130, 299, 400):
        few = stored.newest_days(table, limit)
        want = notify.recent_notifications(table.drop("day"), limit)
        got = notify.recent_notifications(few.select("id", "timestamp"), limit)
        assert got.collect() == want.select("id", "timestamp").collect()
    text = stored.newest_days(table, 5)._jdf.queryExecution().executedPlan().toString()
    assert "day" in re.search(r"PartitionFilters: \[([^]]*)", text)[1]
    assert stored.newest_days(table, 5).count() < 130


def test_deletions_do_not_shuffle_the_notifications(spark, small_dir):
    """Not even where the planner knows too little to broadcast: the ids asked for are
    written and counted before."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, small_dir, "deletion_results_stored")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    semi = text[text.index("LeftSemi"):].split("\n")
    assert "BroadcastHashJoin" in next(line for line in text.split("\n") if "LeftSemi" in line)
    scan = next(i for i, line in enumerate(semi) if "FileScan" in line)
    assert not any("Exchange hashpartitioning" in line for line in semi[:scan])


def test_state_takes_one_shuffle_of_the_scans(spark, sf_dir):
    text = plan(spark, sf_dir, "shipment_state")
    assert text.count("hashpartitioning(shipment_id") == 2  # one per side of the join, none after it


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_cross_join(spark, small_dir, name):
    text = plan(spark, small_dir, name)
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD ["):
        assert operator not in text, operator


def test_entry(spark):
    assert contract.entry(spark).columns == ["location", "window_start", "window_end", "count"]


def test_the_rest_loads_without_the_training_data_operators(tmp_path):
    """What they need is missing, or their folder is."""
    root = Path(contract.__file__).parent
    code = (
        "import sys; sys.path.insert(0, {root!r}); {block}\n"
        "import __spark_entry__ as c; print(len(c.queries()), len(c.oracle_sql()), any(q.startswith('op') for q in c.queries()))"
    )
    for block in ("sys.modules['xxhash'] = None", "sys.modules['waybill.llm'] = None", "sys.modules['corpus_pipeline'] = None"):
        done = subprocess.run(
            [sys.executable, "-c", code.format(root=str(root), block=block)], capture_output=True, text=True, check=True, cwd=tmp_path
        )
        assert done.stdout.split() == [str(len(catalog.QUERIES)), str(len(oracle.ORACLE)), "False"]
