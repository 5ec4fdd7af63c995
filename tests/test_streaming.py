"""Streams against their batch forms, restarts, and the two-way split."""

import json
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.operators import counts, events, gate, late, lifecycle, notify, skew
from waybill.sources import decode, tables, topics
from waybill.streaming import counts as stream_counts
from waybill.streaming import late as stream_late
from waybill.streaming import latest
from waybill.streaming import lifecycle as stream_lifecycle
from waybill.streaming import notifications as stream_notifications
from waybill.streaming import sinks

START = datetime(2024, 1, 15, 10)


def event(minute, location="Berlin", shipment="S-1", **more):
    at = START + timedelta(minutes=minute)
    return {
        "shipmentId": shipment, "destination": "Berlin", "location": location,
        "deliveredAt": at.isoformat(), "correlationId": f"c-{minute}", **more,
    }


def put(folder, name, events):
    folder.mkdir(exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    (folder / name).write_text("\n".join(lines) + "\n")


def deliveries(spark, folder, streaming):
    records = topics.file_records(spark, str(folder), S.TOPIC_DELIVERED, streaming, max_files_per_trigger=1)
    return decode.delivered(decode.decode(records))


def run_counts(spark, tmp_path, folder):
    counted = stream_counts.windowed_counts(deliveries(spark, folder, True))
    writer = stream_counts.counts_writer(counted, str(tmp_path / "counts"))
    sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()


def rows(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


COLUMNS = ("location", "window_start", "window_end", "count")


def test_counts_equal_batch_and_survive_restart(spark, tmp_path):
    folder = tmp_path / "in"
    table = str(tmp_path / "counts")
    assert stream_counts.read_counts(spark, table).collect() == []
    put(folder, "1.json", [event(1), event(2, "  Berlin\t"), event(3, "Hamburg"), event(4, " ")])
    run_counts(spark, tmp_path, folder)
    put(folder, "2.json", [event(5), event(61), event(62)])
    run_counts(spark, tmp_path, folder)
    run_counts(spark, tmp_path, folder)

    streamed = rows(stream_counts.read_counts(spark, table), *COLUMNS)
    batch = counts.delivery_counts(deliveries(spark, folder, False))
    assert streamed == rows(batch, *COLUMNS)
    assert ("Berlin", START, START + timedelta(hours=1), 3) in streamed


def test_a_repeated_batch_does_not_count_twice(spark, tmp_path):
    table = str(tmp_path / "counts")
    one = spark.createDataFrame([("Berlin", START, START + timedelta(hours=1), 2)], S.DELIVERY_COUNT)
    two = spark.createDataFrame([("Berlin", START, START + timedelta(hours=1), 5)], S.DELIVERY_COUNT)
    for batch_id, batch in ((0, one), (1, two), (1, two)):
        sinks.write_batch(batch, table, batch_id)
    assert [r["count"] for r in stream_counts.read_counts(spark, table).collect()] == [5]


def test_compaction_keeps_the_view(spark, tmp_path):
    table = str(tmp_path / "counts")

    def write(batch_id, start, count):
        row = [("Berlin", start, start + timedelta(hours=1), count)]
        sinks.write_batch(spark.createDataFrame(row, S.DELIVERY_COUNT), table, batch_id)

    assert stream_counts.compact(spark, table) is None
    write(0, START - timedelta(days=8), 7)
    write(1, START, 1)
    assert stream_counts.compact(spark, table) == 1
    old = (START - timedelta(days=8), 7)

    def seen(**options):
        return dict(rows(stream_counts.read_counts(spark, table, **options), "window_start", "count"))

    assert seen() == dict([old, (START, 1)])
    assert seen(retention="7 days") == {START: 1}
    write(2, START, 4)
    assert seen() == dict([old, (START, 4)])
    assert stream_counts.compact(spark, table) == 2
    assert seen() == dict([old, (START, 4)])
    # folders that the compaction covers go, and the view and the next compaction stay right
    assert stream_counts.remove_covered(spark, table) == 3
    assert sinks.batch_ids(spark, table) == [2]
    assert seen() == dict([old, (START, 4)])
    write(3, START, 5)
    assert stream_counts.compact(spark, table) == 3
    assert seen() == dict([old, (START, 5)])


def test_a_replay_in_several_triggers_is_complete(spark, tmp_path):
    source = tmp_path / "events"
    events = tables.deliveries(spark, "/root/testdata/sf0.001")
    events.repartition(6, "event_id").write.parquet(str(source))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    counted = stream_counts.windowed_counts(stream, grace=None)
    table = str(tmp_path / "counts")
    writer = stream_counts.counts_writer(counted, table)
    sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert len(sinks.batch_ids(spark, table)) >= 6
    streamed = rows(stream_counts.read_counts(spark, table), *COLUMNS)
    assert streamed == rows(counts.delivery_counts(events), *COLUMNS)


def test_ids_and_times_of_records_from_files(spark, tmp_path):
    folder = tmp_path / "in"
    created = [
        {"shipmentId": f"S-{i}", "destination": "Berlin", "createdAt": START.isoformat(), "correlationId": f"c{i}"}
        for i in range(5)
    ]
    created[1]["timestamp"] = 1705314600.123456789
    created[2]["timestamp"] = "2024-01-15T10:30:00+01:00"
    created[3]["timestamp"] = "whenever"
    put(folder, "1.json", created)
    put(folder, "2.json", [dict(created[0])])
    records = topics.file_records(spark, str(folder), S.TOPIC_CREATED)
    decoded = decode.decode(records)
    notes = notify.notifications(events.decoded_events(decoded))
    first = rows(notes, "id", "shipment_id")
    assert len(first) == 5 and len({i for i, _ in first}) == 5
    assert first == rows(notify.notifications(events.decoded_events(decode.decode(records))), "id", "shipment_id")
    times = dict(rows(decode.created(decoded), "shipment_id", "timestamp"))
    assert times["S-1"] == datetime(2024, 1, 15, 10, 30, 0, 123456)
    assert times["S-2"] == datetime(2024, 1, 15, 9, 30)
    dead = decode.dead_letters(decode.parse(records)).collect()
    assert [r["reason"] for r in dead] == ["unreadable timestamp"]
    assert {r["source_file"].rsplit("/")[-1] for r in decoded.select("source_file").collect()} == {"1.json", "2.json"}


def test_too_late_records_are_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [event(1)])
    run_counts(spark, tmp_path, folder)
    put(folder, "2.json", [event(200)])
    run_counts(spark, tmp_path, folder)
    put(folder, "3.json", [event(201)])
    run_counts(spark, tmp_path, folder)
    put(folder, "4.json", [event(2)])
    run_counts(spark, tmp_path, folder)
    got = dict(rows(stream_counts.read_counts(spark, str(tmp_path / "counts")), "window_start", "count"))
    assert got == {START: 1, START + timedelta(hours=3): 2}


def test_split_into_events_and_dead_letters(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [event(1), '{"shipmentId": "S-', event(2, deliveredAt="soon"), event(3)])
    records = topics.file_records(spark, str(folder), S.TOPIC_DELIVERED, streaming=True)
    writer = sinks.split_writer(records, str(tmp_path / "events"), str(tmp_path / "dead"))
    sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "events")).count() == 2
    dead = spark.read.parquet(str(tmp_path / "dead"))
    assert rows(dead, "dead_letter_topic", "reason") == [
        ("shipment-delivered.DLT", "malformed JSON"),
        ("shipment-delivered.DLT", "unreadable date"),
    ]


def test_outcomes_are_counted_while_decoding(spark, tmp_path):
    """Over several batches, as the same counts over the decoded records."""
    folder, metrics = tmp_path / "in", str(tmp_path / "metrics")
    put(folder, "1.json", [event(1), '{"shipmentId": "S-', event(2, deliveredAt="soon"), event(3)])
    put(folder, "2.json", [event(4), "{"])
    records = topics.file_records(spark, str(folder), S.TOPIC_DELIVERED, streaming=True, max_files_per_trigger=1)
    writer = sinks.split_writer(records, str(tmp_path / "events"), str(tmp_path / "dead"), metrics)
    sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert len(sinks.batch_ids(spark, metrics)) == 2
    assert rows(sinks.read_outcomes(spark, metrics), *sinks.OUTCOMES.names) == [
        (S.DELIVERED_EVENT, "success", 3), ("error", "failure", 3),
    ]
    parsed = decode.parse(topics.file_records(spark, str(folder), S.TOPIC_DELIVERED))
    assert spark.read.parquet(str(tmp_path / "events")).count() == decode.typed(parsed).count() == 3
    assert decode.dead_letters(parsed).count() == 3


def test_retention_frees_what_is_old(spark, tmp_path):
    """A month of event time: the stream's state and the table both stay bounded, and
    what is inside the retention is never touched."""
    source, table = tmp_path / "in", str(tmp_path / "counts")
    schema = "location string, delivered_at timestamp_ntz"
    everything, sizes, states = [], [], []
    for day in range(0, 30, 3):
        part = [("Berlin", START + timedelta(days=day, hours=h, minutes=7)) for h in range(0, 72, 6)]
        everything += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        writer = stream_counts.counts_writer(stream_counts.windowed_counts(stream), table)
        query = sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True)
        query.awaitTermination()
        states.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        stream_counts.compact(spark, table, retention="7 days")
        stream_counts.remove_covered(spark, table)
        kept = stream_counts.read_counts(spark, table)
        sizes.append(kept.count())
        wanted = counts.retained(counts.delivery_counts(spark.createDataFrame(everything, schema)), "7 days")
        inside = stream_counts.read_counts(spark, table, retention="7 days")
        assert rows(inside, *COLUMNS) == rows(wanted, *COLUMNS)
    assert max(sizes) <= 28 and max(states) <= 13 and len(everything) == 120


def scan(shipment, minute, location, destination="Berlin"):
    at = START + timedelta(minutes=minute)
    return {
        "shipmentId": shipment, "location": location, "scannedAt": at.isoformat(),
        "destination": destination, "correlationId": f"{shipment}-{minute}",
    }


REPLAY_COLUMNS = (
    "shipment_id", "seq", "location", "destination", "scanned_at", "created_at",
    "delivered", "delivered_at", "status", "correlation_id",
)


def scans(spark, folder, streaming):
    records = topics.file_records(spark, str(folder), S.TOPIC_SCANNED, streaming, max_files_per_trigger=1)
    return decode.scanned(decode.decode(records))


ORDER = ["scanned_at", "correlation_id"]


def replayed_state(replayed):
    return rows(lifecycle.shipment_state(replayed), *S.SHIPMENT_STATE.names)


def test_life_cycle_equals_batch(spark, tmp_path):
    """Over several runs, the third of them with a shipment that is cut like a hot key."""
    folder = tmp_path / "in"
    table, states = str(tmp_path / "replayed"), str(tmp_path / "state")
    hot = skew.HotKeys(slots=64, factor=2, floor_rows=16)
    trips = [
        [scan("A", 1, "Depot"), scan("B", 2, "Depot", None), scan("C", 2, "berlin"), scan(" ", 3, "Depot")],
        [scan("A", 10, "BERLIN", "Paris"), scan("B", 11, "Berlin"), scan("A", 12, "Depot")],
        [scan("A", 20 + i, ["Berlin", "Depot", "Hub"][i % 3]) for i in range(90)]
        + [scan("H", 20 + i, "Berlin" if i > 40 else "Depot") for i in range(90)],
        [scan("A", 120, "Berlin"), scan("C", 121, " Berlin"), scan("D", 122, "Berlin"), scan("D", 123, None)],
    ]
    for number, trip in enumerate(trips):
        put(folder, f"{number}.json", trip)
        writer = stream_lifecycle.replay_writer(
            scans(spark, folder, True), ORDER, [F.col("scanned_at")], table, states, hot, compact=2
        )
        sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    streamed = sinks.read_batches(spark, table, stream_lifecycle.REPLAYED)
    batch = lifecycle.replay(scans(spark, folder, False), ORDER, [F.col("scanned_at")])
    assert rows(streamed, *REPLAY_COLUMNS) == rows(batch, *REPLAY_COLUMNS)
    state = stream_lifecycle.read_state(spark, states)
    assert rows(state, *S.SHIPMENT_STATE.names) == replayed_state(batch)
    got = {r["shipment_id"]: (r["status"], r["last_location"], r["seq"]) for r in state.collect()}
    assert got == {
        "A": ("DELIVERED", "Berlin", 94), "B": ("IN_TRANSIT", "Berlin", 2), "C": ("DELIVERED", " Berlin", 2),
        "D": ("DELIVERED", None, 2), "H": ("DELIVERED", "Berlin", 90),
    }
    # compactions were written, and without what they cover the answers stay
    assert sinks.batch_ids(spark, states + latest.BASE)
    assert latest.remove_covered(spark, states) > 0
    assert rows(stream_lifecycle.read_state(spark, states), *S.SHIPMENT_STATE.names) == replayed_state(batch)


def test_a_repeated_batch_of_scans_changes_nothing(spark, tmp_path):
    """An attempt that stopped after writing its state is made again."""
    table, states = str(tmp_path / "replayed"), str(tmp_path / "state")
    parts = [[("A", i, "Berlin" if i % 2 else "Depot") for i in range(n, n + 3)] for n in (0, 3, 6)]
    schema = "shipment_id string, scanned_at timestamp_ntz, location string, destination string, correlation_id string"

    def table_of(part):
        return spark.createDataFrame([(s, START + timedelta(minutes=i), at, "Berlin", f"c{i}") for s, i, at in part], schema)

    for number, part in [(0, parts[0]), (1, parts[1]), (1, parts[1]), (2, parts[2]), (2, parts[2])]:
        stream_lifecycle.replay_batch(table_of(part), number, table, states, ORDER, [F.col("scanned_at")], compact=2)
    batch = lifecycle.replay(table_of(sum(parts, [])), ORDER, [F.col("scanned_at")])
    assert rows(sinks.read_batches(spark, table, stream_lifecycle.REPLAYED), *REPLAY_COLUMNS) == rows(batch, *REPLAY_COLUMNS)
    assert rows(stream_lifecycle.read_state(spark, states), *S.SHIPMENT_STATE.names) == replayed_state(batch)


def test_life_cycle_batches_stay_in_the_jvm(spark, tmp_path):
    one = spark.createDataFrame(
        [("A", START, "Berlin", "Berlin", "c")],
        "shipment_id string, scanned_at timestamp_ntz, location string, destination string, correlation_id string",
    )
    states = str(tmp_path / "state")
    stream_lifecycle.replay_batch(one, 0, str(tmp_path / "replayed"), states, ORDER, [F.col("scanned_at")])
    plan = stream_lifecycle.go_on(one, 1, states, ORDER, [F.col("scanned_at")])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and plan.count("Window [") >= 2


def test_life_cycle_of_the_tables(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    source = tmp_path / "scans"
    table = str(tmp_path / "replayed")
    all_scans = tables.scans(spark, small)
    # scans of a shipment come in their order, spread over the triggers
    third = F.ntile(3).over(Window.partitionBy("shipment_id").orderBy(*tables.SCAN_ORDER))
    parted = all_scans.withColumn("part", third)
    for part in (1, 2, 3):
        parted.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(all_scans.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        writer = stream_lifecycle.replay_writer(
            stream, tables.SCAN_ORDER, tables.scan_chunk(), table, str(tmp_path / "state")
        )
        sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    streamed = sinks.read_batches(spark, table, stream_lifecycle.REPLAYED).select(*REPLAY_COLUMNS)
    batch = lifecycle.replay(all_scans, tables.SCAN_ORDER, tables.scan_chunk()).select(*REPLAY_COLUMNS)
    assert streamed.exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed).count() == 0


@pytest.mark.parametrize("clock, seed", [(["location"], 1), (["location"], 2), ([], 3)])
def test_late_data_in_a_stream_is_judged_by_the_rule(spark, tmp_path, clock, seed):
    """Whatever way the arrivals are cut into batches."""
    chance = random.Random(seed)
    arrivals = [
        (n, chance.choice(["Berlin", "Hamburg", None]), START + timedelta(minutes=3 * n + chance.randrange(-200, 60)))
        for n in range(120)
    ]
    schema = "n long, location string, delivered_at timestamp_ntz"
    every = spark.createDataFrame(arrivals, schema)
    wanted = late.with_lateness(every, ["n"], clock=clock)
    source, paths = tmp_path / "in", [str(tmp_path / name) for name in ("counts", "late", "clocks")]
    cuts = sorted(chance.sample(range(1, 120), 5))
    for number, (begin, end) in enumerate(zip([0, *cuts], [*cuts, 120])):
        spark.createDataFrame(arrivals[begin:end], schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        writer = stream_late.late_writer(stream, ["n"], *paths, clock=clock, compact=2)
        sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    dropped = sinks.read_batches(spark, paths[1], every.schema)
    assert 0 < dropped.count() < 120
    assert rows(dropped, "n") == rows(wanted.filter("late"), "n")
    kept = wanted.filter("not late").groupBy("location", "window_start", "window_end").agg(F.count("*").alias("count"))
    assert rows(stream_late.read_counts(spark, paths[0]), *COLUMNS) == rows(kept, *COLUMNS)


@pytest.mark.parametrize("streaming", [True, False])
def test_kafka_needs_its_connector(spark, streaming):
    with pytest.raises(Exception, match="kafka"):
        topics.kafka_records(spark, "nowhere:9092", ["a", "b"], streaming, max_per_trigger=10)


def created(shipment, minute, destination="Berlin"):
    return {"shipmentId": shipment, "destination": destination, "createdAt": (START + timedelta(minutes=minute)).isoformat()}


def mixed_records(spark, root, streaming):
    """The three topics as one, each a folder of files."""
    parts = [
        topics.file_records(spark, str(root / topic), topic, streaming, max_files_per_trigger=1)
        for topic in (S.TOPIC_CREATED, S.TOPIC_SCANNED, S.TOPIC_DELIVERED)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def test_notifications_from_three_topics(spark, tmp_path):
    root, table, dead = tmp_path / "in", str(tmp_path / "notes"), str(tmp_path / "dead")
    root.mkdir()
    for number in range(2):  # stops and starts again between the rounds
        put(root / S.TOPIC_CREATED, f"{number}.json", [created(f"S{number}-{i}", i) for i in range(3)] + ["{"])
        put(root / S.TOPIC_SCANNED, f"{number}.json", [scan(f"S{number}-{i}", i, "Depot") for i in range(2)])
        put(root / S.TOPIC_DELIVERED, f"{number}.json", [event(number, shipment=f"S{number}-0"), event(9 + number, shipment=" ")])
        writer = stream_notifications.notifications_writer(mixed_records(spark, root, True), table, dead)
        sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    streamed = stream_notifications.read_notifications(spark, table)
    batch = stream_notifications.notification_stream(mixed_records(spark, root, False))
    assert rows(streamed, *streamed.columns) == rows(batch, *streamed.columns)
    assert streamed.count() == 12
    letters = sinks.read_batches(spark, dead, S.struct("topic string, reason string"))
    assert [r for _, r in rows(letters, "topic", "reason")] == ["malformed JSON"] * 2 + [notify.NO_SHIPMENT] * 2


def test_scan_gate_as_a_stream(spark, tmp_path):
    schema = "kind string, at timestamp_ntz, shipment_id string, destination string, location string, request_id string"

    def moment(minute):
        return START + timedelta(minutes=minute)

    batches = [
        [("create", moment(0), "A", "Berlin", None, None), ("scan", moment(1), "A", None, "Depot", "1"),
         ("scan", moment(1), "B", None, "Depot", "2"), ("scan", moment(2), None, None, "Depot", "3")],
        [("create", moment(3), "B", "Paris", None, None), ("scan", moment(4), "B", None, "Depot", "4"),
         ("scan", moment(5), "A", None, " ", "5"), ("scan", moment(6), "A", None, "Hub", "6")],
        [("create", moment(7), "A", "Rome", None, None), ("scan", moment(8), "A", None, "Hub", "7")]
        + [("scan", moment(9 + i), "B", None, "Hub", f"b{i}") for i in range(50)],  # one busy shipment
    ]
    folder = tmp_path / "in"
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(schema).parquet(str(folder))
        writer = stream_notifications.gate_writer(stream, str(tmp_path / "answers"), ["request_id"])
        sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    every = spark.createDataFrame(sum(batches, []), schema)
    batch = gate.scan_results(
        every.filter("kind = 'scan'").select("request_id", "shipment_id", "location", F.col("at").alias("scanned_at")),
        every.filter("kind = 'create'").select("shipment_id", "destination", F.col("at").alias("created_at")),
        ["request_id"],
    )
    names = ("request_id", "shipment_id", "location", "destination", "success", "error_message")
    streamed = stream_notifications.read_answers(spark, str(tmp_path / "answers"))
    assert rows(streamed, *names) == rows(batch, *names)
    assert streamed.filter("success").count() == 54


def test_a_gate_batch_costs_the_same_after_many(spark, tmp_path):
    """Fifty batches, each with new creates: none reads what earlier ones had."""
    schema = "kind string, at timestamp_ntz, shipment_id string, destination string, location string, request_id string"
    folder = tmp_path / "in"
    made = [
        row
        for n in range(50) for i in range(20)
        for row in (
            ("create", START + timedelta(minutes=2 * n), f"S{n}-{i}", "Berlin", None, None),
            ("scan", START + timedelta(minutes=2 * n + 1), f"S{n * 7 % (n + 1)}-{i}", None, "Depot", f"{n}-{i}"),
        )
    ]
    numbered = spark.createDataFrame([(k // 40, *row) for k, row in enumerate(made)], f"n int, {schema}")
    for n in range(50):  # one file a trigger, in the order of their times
        numbered.filter(F.col("n") == n).drop("n").coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    writer = stream_notifications.gate_writer(stream, str(tmp_path / "answers"), ["request_id"])
    query = sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True)
    query.awaitTermination()
    steps = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(steps) == 50 and all(p["numInputRows"] == 40 for p in steps)
    took = [p["durationMs"]["triggerExecution"] for p in steps]
    assert statistics.median(took[-15:]) < 1.5 * statistics.median(took[5:20]) + 200
    state = steps[-1]["stateOperators"][0]
    assert state["numRowsTotal"] == 1000
    answers = stream_notifications.read_answers(spark, str(tmp_path / "answers"))
    assert answers.count() == 1000 and answers.filter("success").count() == 1000


def test_redelivered_records_count_once(spark, tmp_path):
    """In another batch, after a restart, or in the same one; the table is read as it is."""
    folder, table, dead = tmp_path / "in", str(tmp_path / "notes"), str(tmp_path / "dead")

    def record(offset, minute, value=None):
        text = json.dumps(created(f"S{offset}", 0)) if value is None else value
        return (S.TOPIC_CREATED, 0, offset, START + timedelta(minutes=minute), None, None, text)

    for batch in ([record(0, 0), record(1, 1), record(1, 2)], [record(1, 9), record(2, 10), record(3, 10, "{")], [record(3, 12, "{")]):
        spark.createDataFrame(batch, S.RECORD).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(S.RECORD).parquet(str(folder))
        writer = stream_notifications.notifications_writer(stream, table, dead)
        sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    streamed = stream_notifications.read_notifications(spark, table)
    assert [r["shipment_id"] for r in streamed.orderBy("shipment_id").collect()] == ["S0", "S1", "S2"]
    assert "Exchange" not in streamed._jdf.queryExecution().executedPlan().toString()
    assert sinks.read_batches(spark, dead, S.struct("reason string")).count() == 1


def test_identical_lines_are_records_of_their_own(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "notes")
    put(folder, "1.json", [created("S", 1), created("S", 1), created("T", 1)])
    put(folder, "2.json", [created("S", 1)])

    def read(streaming=False):
        return topics.file_records(spark, str(folder), S.TOPIC_CREATED, streaming, max_files_per_trigger=1)

    first = rows(stream_notifications.notification_stream(read()), "id", "shipment_id")
    assert [s for _, s in first].count("S") == 3 and len({i for i, _ in first}) == 4
    assert first == rows(stream_notifications.notification_stream(read()), "id", "shipment_id")
    writer = stream_notifications.notifications_writer(read(True), table, str(tmp_path / "dead"))
    sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert rows(stream_notifications.read_notifications(spark, table), "id", "shipment_id") == first


def test_chain_from_scans_to_counts(spark, tmp_path):
    folder = tmp_path / "in"
    order = ["scanned_at", "correlation_id"]
    trips = [
        [scan("A", 1, "Depot"), scan("A", 2, "Berlin"), scan("B", 3, "Depot")],
        [scan("B", 50, "berlin"), scan("A", 55, "Berlin"), scan("C", 61, "Berlin")],
        [scan("H", 70 + i, "Berlin" if i % 2 else "Depot") for i in range(60)] + [scan("B", 200, "Berlin")],
    ]
    for number, trip in enumerate(trips):
        put(folder, f"{number}.json", trip)
        writer = stream_notifications.chain_writer(
            scans(spark, folder, True), order, [F.col("scanned_at")],
            str(tmp_path / "replayed"), str(tmp_path / "state"), str(tmp_path / "counts"),
        )
        sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    batch = lifecycle.replay(scans(spark, folder, False), order, [F.col("scanned_at")])
    wanted = counts.delivery_counts(lifecycle.delivered_events(batch))
    streamed = stream_notifications.read_chained_counts(spark, str(tmp_path / "counts"))
    assert rows(streamed, *COLUMNS) == rows(wanted, *COLUMNS)
    assert streamed.agg(F.sum("count")).first()[0] == 35
