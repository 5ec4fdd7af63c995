"""The exact late-data rule, replayed over recorded arrivals.

A stream clock shows the highest event time seen so far.  A record is dropped
from a window when the window's end plus the grace period is not after the
clock, the record itself included.

Read the other way round, every window has one record that closes it: the
earliest arrival whose event time is at least end plus grace.  A record is late
exactly when it does not arrive before that one.  The closing arrivals are a
minimum per window, which needs no pass over the rows in order, so a clock that
sees all rows is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.operators.counts import WINDOW
from waybill.operators.skew import sized_broadcast

GRACE = "5 minutes"


def _assigned(events: DataFrame, time: str, size: str, slide: str) -> DataFrame:
    return (
        events.withColumn("_w", F.window(time, size, slide))
        .withColumn("window_start", F.col("_w.start"))
        .withColumn("window_end", F.col("_w.end"))
        .drop("_w")
    )


def _position(order: list[str]) -> Column:
    """A single column stays bare, so that its minimum is a hash aggregate."""
    return F.struct(*order) if len(order) > 1 else F.col(order[0])


def closing_arrivals(
    events: DataFrame, order: list[str], clock: list[str], time: str, size: str, slide: str, grace: str
) -> DataFrame:
    """Per clock and window the arrival that closes it: ``closed_by``, null if none does.

    One pass over the events marks both what each row belongs to and what it closes.
    """
    # the last window a row closes, and with it all earlier ones
    shifted = F.col(time) - F.expr(f"INTERVAL {size}") - F.expr(f"INTERVAL {grace}")
    rows = _assigned(events, time, size, slide).withColumn("closes", F.window(shifted, slide)["start"])
    position = _position(order)
    marks = (
        rows.select(*clock, F.explode(F.array(
            F.struct(F.col("window_start").alias("w"), F.lit(None).cast(_type(rows, position)).alias("a"), F.lit(True).alias("asked")),
            F.struct(F.col("closes").alias("w"), position.alias("a"), F.lit(False).alias("asked")),
        )).alias("m"))
        .groupBy(*clock, F.col("m.w").alias("window_start"))
        .agg(F.min("m.a").alias("a"), F.max("m.asked").alias("asked"))
    )
    # One row per clock and window from here on.  The minimum over this and all later
    # windows goes day by day: within a day by a window, across days over one row a day.
    day = F.date_trunc("day", "window_start")
    marks = marks.withColumn("_day", day)
    within = (
        Window.partitionBy(*clock, "_day").orderBy(F.col("window_start").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    days = marks.groupBy(*clock, "_day").agg(F.min("a").alias("_least"))
    after = (
        Window.partitionBy(*(clock or [F.lit(0)])).orderBy(F.col("_day").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    later = days.withColumn("_later", F.min("_least").over(after)).drop("_least")
    return (
        marks.withColumn("_here", F.min("a").over(within))
        .join(later, [*clock, "_day"])
        .withColumn("closed_by", F.least("_here", "_later"))
        .filter("asked")
        .select(*clock, "window_start", "closed_by")
    )


def _type(rows: DataFrame, column: Column) -> str:
    return rows.select(column.alias("c")).schema["c"].dataType.simpleString()


def with_lateness(
    events: DataFrame,
    order: list[str],
    clock: list[str] = ("location",),
    time: str = "delivered_at",
    size: str = WINDOW,
    slide: str | None = None,
    grace: str = GRACE,
    broadcast_rows: int = 1_000_000,
    before: DataFrame | None = None,
) -> DataFrame:
    """Every event once per window, with ``late``.

    ``order`` is the total order of arrival; ``clock`` the columns that share a
    clock (the location by default; a partition column; none for one clock over
    everything).

    ``before`` (see ``clocks``) is what each clock showed before the first of these
    events: a window that it has closed takes no more of them.
    """
    slide = slide or size
    clock = list(clock)
    closing = closing_arrivals(events, order, clock, time, size, slide, grace)
    if before is not None:
        shows = before.select(*clock, F.col(time).alias("_shown"))
        closing = closing.join(F.broadcast(shows), F.lit(True), "left") if not clock else closing.join(
            shows.toDF(*[f"_{c}" for c in clock], "_shown"),
            [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in clock], "left",
        ).drop(*[f"_{c}" for c in clock])
        ends = F.col("window_start") + F.expr(f"INTERVAL {size}") + F.expr(f"INTERVAL {grace}")
        closing = closing.withColumn("closed", F.col("_shown") >= ends).drop("_shown")
    else:
        closing = closing.withColumn("closed", F.lit(False))
    closing = sized_broadcast(closing, broadcast_rows)
    late: Column = F.coalesce(F.col("closed"), F.lit(False)) | F.coalesce(
        _position(order) >= F.col("closed_by"), F.lit(False)
    )
    return (
        _assigned(events, time, size, slide)
        .join(closing, [*clock, "window_start"], "left")
        .withColumn("late", late)
        .drop("closed_by", "closed")
    )


def clocks(
    events: DataFrame, clock: list[str] = ("location",), time: str = "delivered_at", before: DataFrame | None = None
) -> DataFrame:
    """What each clock shows after these events: the highest event time of all so far."""
    rows = events.select(*clock, time)
    rows = rows if before is None else rows.unionByName(before.select(*clock, time))
    return rows.groupBy(*clock).agg(F.max(time).alias(time)).filter(F.col(time).isNotNull())


def counts_with_grace(events: DataFrame, order: list[str], **options) -> DataFrame:
    """Counts over the records that are not late."""
    return (
        with_lateness(events, order, **options)
        .filter("not late")
        .groupBy("location", "window_start", "window_end")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def late_deliveries(events: DataFrame, order: list[str], **options) -> DataFrame:
    return with_lateness(events, order, **options).filter("late").drop("late")
