"""Event streams derived from the order tables, which stand in for topics.

An order is a shipment to its customer's nation; a line item is a scan at its
supplier's nation; an ``events`` row is a delivery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from waybill import schemas as S
from waybill.functions import times
from waybill.sources import logs

# Arrival of the scans of one shipment; with the shipment it is unique.
SCAN_ORDER = ["scanned_at", "line", "part", "supplier", "quantity", "price"]
# An overfull shipment is cut by day and line.
SCAN_CHUNK = ["scanned_at", "line"]
ARRIVAL_ORDER = ["arrival", "event_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")


def _of_order(rows: DataFrame, column: str, shipment_id: str | None) -> DataFrame:
    """Rows of one shipment, compared as the stored number so that it reaches the scan."""
    if shipment_id is None:
        return rows
    if not (shipment_id.isascii() and shipment_id.isdigit() and str(int(shipment_id)) == shipment_id):
        return rows.limit(0)  # no order has such a key
    return rows.filter(F.col(column) == F.lit(int(shipment_id)).cast(rows.schema[column].dataType))


def _orders_to(spark: SparkSession, sf_dir: str, shipment_id: str | None = None) -> DataFrame:
    """Orders with their customer, then its nation: the size of a bare table is known,
    that of a join is taken for the product of its sides, which is never broadcast."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = _of_order(table(spark, sf_dir, "orders"), "o_orderkey", shipment_id)
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumnRenamed("n_name", "destination")
        .drop("c_nationkey", "n_nationkey")
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created shipments, one per order."""
    regions = table(spark, sf_dir, "region")
    return _orders_to(spark, sf_dir).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("o_orderkey").cast("string").alias("shipment_id"),
        F.col("r_name").alias("origin"),
        "destination",
        F.col("c_name").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderkey"),
        F.concat_ws("-", F.lit("create"), F.col("o_orderkey")).alias("correlation_id"),
        F.concat_ws(
            ":", F.lit(S.TOPIC_CREATED), F.col("o_orderkey") % 3, F.expr("o_orderkey div 3")
        ).alias("record_id"),
    )


def created(spark: SparkSession, sf_dir: str, shipment_id: str | None = None) -> DataFrame:
    """Created events without the request's own columns; of all shipments or one."""
    return _orders_to(spark, sf_dir, shipment_id).select(
        F.col("o_orderkey").cast("string").alias("shipment_id"),
        "destination",
        F.col("o_orderdate").alias("created_at"),
        "o_orderkey",
        F.concat_ws("-", F.lit("create"), F.col("o_orderkey")).alias("correlation_id"),
        F.concat_ws(
            ":", F.lit(S.TOPIC_CREATED), F.col("o_orderkey") % 3, F.expr("o_orderkey div 3")
        ).alias("record_id"),
    )


def recreated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created events with a second create, elsewhere and 200 days on, for every tenth order."""
    first = created(spark, sf_dir).select("shipment_id", "destination", "created_at", "o_orderkey")
    again = first.filter(F.col("o_orderkey") % 10 == 0).select(
        "shipment_id",
        F.concat(F.lit("NEW_"), F.col("destination")).alias("destination"),
        (F.col("created_at") + F.expr("INTERVAL 200 DAYS")).alias("created_at"),
        "o_orderkey",
    )
    return first.unionByName(again).drop("o_orderkey")


def scan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipment ids of all scans, read from one column."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("shipment_id"))


def _lines(spark: SparkSession, sf_dir: str, shipment_id: str | None = None) -> DataFrame:
    """Lines with their supplier, then its nation, see ``_orders_to``."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = _of_order(table(spark, sf_dir, "lineitem"), "l_orderkey", shipment_id)
    return (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_nations(spark, sf_dir).drop("n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumnRenamed("n_name", "location")
        .drop("s_nationkey", "n_nationkey")
    )


_SCAN_IDENTITY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _arrival() -> list[Column]:
    """The columns of SCAN_ORDER."""
    return [
        F.col("l_shipdate").alias("scanned_at"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    ]


def _any_case(location: Column) -> Column:
    """Locations arrive in either case."""
    return F.when(F.col("l_partkey") % 2 == 0, F.lower(location)).otherwise(location)


def bare_scans(spark: SparkSession, sf_dir: str, shipment_id: str | None = None) -> DataFrame:
    """Scanned events with the destination of their shipment, but without the ids that
    ``with_ids`` makes of the rest; of all shipments or one.

    Joined on the shipment id itself, so that the join's partitioning serves
    whatever groups by shipment next.
    """
    destinations = _orders_to(spark, sf_dir, shipment_id).select(
        F.col("o_orderkey").cast("string").alias("shipment_id"), "destination"
    )
    lines = _lines(spark, sf_dir, shipment_id).select(
        F.col("l_orderkey").cast("string").alias("shipment_id"),
        *_arrival(),
        _any_case(F.col("location")).alias("location"),
    )
    return lines.join(destinations, "shipment_id")


def with_ids(scans: DataFrame) -> DataFrame:
    """Scans with ``correlation_id`` and ``record_id``, which take more room than the
    columns they are made of: add them after whatever moves or sorts the scans."""
    identity = ("shipment_id", "line", "part", "supplier")
    return scans.select(
        "*",
        F.concat_ws("-", *identity).alias("correlation_id"),
        F.concat_ws(":", F.lit(S.TOPIC_SCANNED), *identity).alias("record_id"),
    )


def scans(spark: SparkSession, sf_dir: str, shipment_id: str | None = None) -> DataFrame:
    """Scanned events with ids and the destination of their shipment; of all shipments or one."""
    rows = with_ids(bare_scans(spark, sf_dir, shipment_id))
    return rows.select("shipment_id", *SCAN_ORDER, "correlation_id", "record_id", "location", "destination")


def scan_chunk() -> list[Column]:
    return [F.col(c) for c in SCAN_CHUNK]


def dirty_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans as deliveries, some with padded and some with blank or no location."""
    line = F.col("l_linenumber")
    location = (
        F.when(line == 7, F.lit(" \t\n "))
        .when(line % 5 == 0, F.lit(None).cast("string"))
        .when(line % 3 == 0, F.concat(F.lit("\t  "), F.col("location"), F.lit(" \n")))
        .otherwise(F.col("location"))
    )
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("shipment_id"),
        location.alias("location"),
        F.col("l_shipdate").alias("delivered_at"),
    )


def _asked_id() -> Column:
    """The id a scan request names: some name none, some a shipment nobody made."""
    shipment, part = F.col("l_orderkey").cast("string"), F.col("l_partkey")
    return (
        F.when((F.col("l_linenumber") == 5) & (part % 2 == 0), F.lit(None).cast("string"))
        .when(part % 50 == 1, F.concat(F.lit("X-"), shipment))
        .when(part % 50 == 2, F.lit("  "))
        .otherwise(shipment)
        .alias("shipment_id")
    )


def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipment ids of all scan requests; the missing and blank ones are many of a kind."""
    return table(spark, sf_dir, "lineitem").select(_asked_id())


def scan_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan requests: some without id or location, some for shipments nobody made."""
    line = F.col("l_linenumber")
    location = (
        F.when(line == 6, F.lit(None).cast("string")).when(line == 7, F.lit("  ")).otherwise(F.col("location"))
    )
    return _lines(spark, sf_dir).select(
        _asked_id(), location.alias("location"), *_arrival(), F.concat_ws("-", *_SCAN_IDENTITY).alias("request_id")
    )


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids asked for: one per order, some misshapen, some unknown."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 5 == 0, F.concat(F.lit("no/"), key.cast("string")))
        .when(key % 7 == 0, F.concat(F.lit("X-"), key.cast("string")))
        .otherwise(key.cast("string"))
        .alias("shipment_id")
    )


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("shipment_id"))


def delivery_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual delivery of every finished order, some requests absent or blank."""
    key = F.col("o_orderkey")
    request = F.struct(
        F.when(key % 11 == 0, F.lit(" ")).otherwise(key.cast("string")).alias("shipment_id"),
        F.when(key % 13 == 0, F.lit("")).otherwise(F.col("destination")).alias("location"),
    )
    return _orders_to(spark, sf_dir).filter("o_orderstatus = 'F'").select(
        F.concat_ws("-", F.lit("deliver"), key).alias("request_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("requested_at"),
        F.when(key % 17 != 0, request).alias("request"),
    )


def shipment_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create requests, with blanks in each field now and then."""
    key = F.col("o_orderkey")
    return shipments(spark, sf_dir).select(
        F.concat_ws("-", F.lit("request"), key).alias("request_id"),
        F.when(key % 7 == 0, F.lit(" \t")).otherwise(F.col("origin")).alias("origin"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.col("destination")).alias("destination"),
        F.when(key % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.col("created_at").alias("requested_at"),
    )


def as_deliveries(events: DataFrame) -> DataFrame:
    """Rows of the events table, still or streaming, as deliveries."""
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("shipment_id"),
        F.col("event_type").alias("location"),
        F.col("ts").alias("delivered_at"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered events at clock-time grain."""
    return as_deliveries(table(spark, sf_dir, "events"))


def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, arriving up to three hours after their time."""
    delay = F.make_dt_interval(mins=(F.col("event_id") * 37 % 180).cast("int"))
    return deliveries(spark, sf_dir).withColumn("arrival", F.col("delivered_at") + delay)


def delivered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered events as topic records.

    Dates alternate between the two forms; every fourth record has no envelope
    time, odd ones no version; each has a property nobody knows.
    """
    key = F.col("event_id")
    array = F.to_json(times.datetime_array("delivered_at"))
    date = F.when(key % 2 == 0, F.concat(F.lit('"'), times.iso_datetime("delivered_at"), F.lit('"'))).otherwise(array)
    rest = F.to_json(
        F.struct(
            F.col("shipment_id").alias("shipmentId"),
            F.lit("anywhere").alias("destination"),
            "location",
            F.concat_ws("-", F.lit("corr"), key).alias("correlationId"),
            F.when(key % 4 != 0, F.concat(times.iso_datetime("delivered_at"), F.lit("Z"))).alias("timestamp"),
            F.when(key % 2 == 0, F.lit("v2")).alias("version"),
            F.lit("ignored").alias("surplus"),
        )
    )
    value = F.concat(F.lit('{"deliveredAt":'), date, F.lit(","), F.substr(rest, F.lit(2)))
    return deliveries(spark, sf_dir).select(
        F.lit(S.TOPIC_DELIVERED).alias("topic"),
        (key % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        (F.col("delivered_at") + F.expr("INTERVAL 1 SECOND")).alias("timestamp"),
        F.lit(None).cast("string").alias("type_id"),
        F.col("shipment_id").alias("key"),
        value.alias("value"),
        "event_id",
    )


def broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with every 97th value cut off, every 89th of a foreign class
    and every 83rd without a readable date."""
    key, value = F.col("event_id"), F.col("value")
    unreadable = F.regexp_replace(value, r'^\{"deliveredAt":("[^"]*"|\[[^\]]*\])', '{"deliveredAt":"soon"')
    return delivered_records(spark, sf_dir).withColumn(
        "type_id", F.when(key % 89 == 0, F.lit("org.example.Parcel"))
    ).withColumn(
        "value",
        F.when(key % 97 == 0, F.substr(value, F.lit(1), F.char_length(value) - 5))
        .when(key % 83 == 0, unreadable)
        .otherwise(value),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines of two services; some informational lines mention an error."""
    key = F.col("event_id")
    error = F.col("event_type") == "error"
    second = F.substring(F.col("ts").cast("string"), 1, 19)
    message = F.when(
        error, F.concat(F.lit("failed on "), key.cast("string"))
    ).when(key % 10 == 0, F.concat(F.lit("no Errors in "), key.cast("string"))).otherwise(
        F.concat(F.lit("handled "), key.cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, F.lit("analytics")).otherwise("notifications").alias("service"),
        F.format_string(
            logs.RENDERED,
            second,
            F.concat_ws("-", F.lit("worker"), F.col("user_id") % 4),
            F.when(error, F.lit("ERROR")).otherwise("INFO"),
            F.lit("app.Handler"),
            message,
        ).alias("value"),
    )
