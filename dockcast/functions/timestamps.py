"""Timestamp expressions. Internally every time is a TIMESTAMP_NTZ wall clock, so no result depends on the session zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_DAY = 86_400_000_000
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def parse_ts(c: Column) -> Column:
    """Anything to a wall-clock timestamp; NULL where it does not parse."""
    return c.try_cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a wall-clock timestamp, read off its fields so that order is kept in any session zone."""
    day = F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(MICROS_PER_DAY)
    minutes = (F.hour(ts) * 60 + F.minute(ts)).cast("bigint") * F.lit(MICROS_PER_MINUTE)
    seconds = F.rint(F.extract(F.lit("SECOND"), ts).cast("double") * F.lit(1e6)).cast("bigint")
    return day + minutes + seconds


def from_micros(us: Column) -> Column:
    """The inverse of micros()."""
    days = F.floor(us / F.lit(MICROS_PER_DAY).cast("bigint")).cast("int")
    rest = F.pmod(us, F.lit(MICROS_PER_DAY))
    seconds = (rest.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def micros_of(value: datetime) -> int:
    """Driver-side micros() of a naive datetime."""
    delta = value - datetime(1970, 1, 1)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def lit_ts(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    """Truncate to the hour without leaving TIMESTAMP_NTZ (date_trunc would return a zoned timestamp)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.lit(0), F.lit(0).cast("decimal(8,6)"))


def add_minutes(ts: Column, minutes: Column | int) -> Column:
    m = F.lit(minutes) if isinstance(minutes, int) else minutes
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), m.cast("int"))


def minutes(count: float) -> Column:
    """A duration."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(count * 60).cast("decimal(18,6)"))


def utc_wall_clock(zoned: Column) -> Column:
    """UTC wall clock of a TIMESTAMP (zoned) column, from its absolute microseconds."""
    return from_micros(F.unix_micros(zoned))


def to_naive(zoned: Column, mode: str = "utc", zone: str = "UTC") -> Column:
    """Drop the zone of a TIMESTAMP column.

    mode 'utc' keeps the UTC wall clock (what the original data job really does, although it
    claims to keep the local hour); mode 'local' keeps the wall clock of `zone`.
    """
    utc = utc_wall_clock(zoned)
    if mode == "utc":
        return utc
    if mode == "local":
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    raise ValueError(f"mode must be 'utc' or 'local', not {mode!r}")


def parse_wall_clock(c: Column, kind: str, mode: str = "utc", zone: str = "UTC") -> Column:
    """Anything to a wall clock, whatever the session zone: instants by to_naive(), other text as it stands; NULL where it does not parse."""
    if kind == "timestamp":
        return to_naive(c, mode, zone)
    if kind != "string":
        return parse_ts(c)
    offset = c.rlike(r"[0-9][ ]*([Zz]|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})[ ]*$") & c.contains(":")
    return F.when(offset, to_naive(c.try_cast("timestamp"), mode, zone)).otherwise(parse_ts(c))


def ensure_zone_instant(ts: Column, zone: str, is_naive: bool) -> Column:
    """Localise a wall clock to `zone`, or leave a zoned value alone; the answer is the UTC wall clock of that instant."""
    if is_naive:
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    return utc_wall_clock(ts)


def ensure_zone_wall_clock(ts: Column, zone: str, is_naive: bool) -> Column:
    """The wall clock in `zone`: unchanged for a naive value, converted for a zoned one."""
    return ts if is_naive else to_naive(ts, "local", zone)
