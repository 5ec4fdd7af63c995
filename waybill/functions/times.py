"""Date-time rules.  Values at rest are TIMESTAMP_NTZ in UTC, so no result
depends on the session's time zone."""

from __future__ import annotations

from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_DATE_ARRAY = r"^\[(\d{4}),(\d+),(\d+),(\d+),(\d+),(\d+),(\d+)(?:,0)*$"
_ISO_LOCAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch() -> Column:
    return F.expr(_EPOCH)


def _whole(micros: Column, unit: int) -> Column:
    """Whole units of so many microseconds, rounded down."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(unit)), F.lit(unit))


def _second_micros(moment: Column) -> Column:
    return (F.extract(F.lit("SECOND"), moment) * F.lit(1_000_000)).cast("bigint")


def epoch_micros(moment) -> Column:
    """Put together from the fields: timestamp_diff would pass through the
    session's zone and miss times its clocks skip."""
    moment = _col(moment)
    day = F.unix_date(moment.cast("date")).cast("bigint")
    minute = (day * 24 + F.hour(moment)) * 60 + F.minute(moment)
    return minute * F.lit(60_000_000) + _second_micros(moment)


def epoch_millis(moment) -> Column:
    return _whole(epoch_micros(moment), 1_000)


def minutes_between(start, end) -> Column:
    return _whole(epoch_micros(end) - epoch_micros(start), 60_000_000)


def to_instant(moment) -> Column:
    """TIMESTAMP_NTZ (UTC) -> TIMESTAMP, which watermarks need."""
    return F.timestamp_micros(epoch_micros(moment))


def from_instant(moment) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (UTC)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(moment)), epoch())


def read_datetime(text) -> Column:
    """Read ``2024-01-15T10:30:00`` or ``[2024,1,15,10,30]`` (trailing zero fields left out)."""
    raw = F.trim(_col(text))
    # padded to seven fields at least, then rewritten as one text to cast
    fields = F.concat(F.rtrim(F.translate(raw, " ", ""), F.lit("]")), F.lit(",0,0"))
    second = F.regexp_replace(fields, _DATE_ARRAY, "$1-$2-$3 $4:$5:$6.")
    micros = F.substring(F.lpad(F.regexp_extract(fields, _DATE_ARRAY, 7), 9, "0"), 1, 6)
    readable = F.when(raw.startswith("["), F.concat(second, micros)).when(raw.rlike(_ISO_LOCAL), raw)
    return readable.try_cast("timestamp_ntz")


def iso_datetime(moment) -> Column:
    """``2024-01-15T10:30:00``, with a fraction only where there is one."""
    return F.translate(_col(moment).cast("string"), " ", "T")


def datetime_array(moment) -> Column:
    """``[2024, 1, 15, 10, 30]``: seconds and nanoseconds only where not zero."""
    moment = _col(moment)
    nanos = F.pmod(_second_micros(moment), F.lit(1_000_000)).cast("int") * 1000
    fields = F.array(
        F.year(moment), F.month(moment), F.dayofmonth(moment),
        F.hour(moment), F.minute(moment), F.second(moment), nanos,
    )
    size = F.when(nanos > 0, 7).when(F.second(moment) > 0, 6).otherwise(5)
    return F.when(moment.isNotNull(), F.slice(fields, F.lit(1), size))


def known_zone(zone: str | None) -> str:
    """The zone's name, or UTC where it is missing or unknown."""
    try:
        return ZoneInfo(zone).key
    except Exception:  # noqa: BLE001 - any unusable name means UTC
        return "UTC"


def event_time(local_time, record_time=None, now=None, zone: str | None = "UTC") -> Column:
    """Event time in UTC: the local time in ``zone``; failing that the record's
    own time if it is after the epoch; failing that ``now``."""
    name = known_zone(zone)
    local_time = _col(local_time)
    in_utc = local_time if name == "UTC" else F.convert_timezone(F.lit(name), F.lit("UTC"), local_time)
    choices = [in_utc]
    if record_time is not None:
        record_time = _col(record_time)
        choices.append(F.when(record_time > epoch(), record_time))
    choices.append(_col(now) if now is not None else from_instant(F.current_timestamp()))
    return F.coalesce(*choices)


def clock_display(moment) -> Column:
    """``Jan 15 10:30``, or ``N/A`` for null."""
    moment = _col(moment)
    day = F.date_format(moment.cast("date"), "MMM dd")
    minute = F.substring(moment.cast("string"), 12, 5)
    return F.when(moment.isNull(), F.lit("N/A")).otherwise(F.concat_ws(" ", day, minute))
