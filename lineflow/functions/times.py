"""Units of time, epochs and ISO texts, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("ns", "us", "ms")


def check_unit(unit: str) -> str:
    if unit not in UNITS:
        raise ValueError(f"unknown timestamp unit {unit!r}, expected one of {UNITS}")
    return unit


def whole_div(c: Column, by: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", c, F.lit(by).cast("bigint"))


def to_micros(c: Column, unit: str) -> Column:
    check_unit(unit)
    c = c.cast("bigint")
    return whole_div(c, 1000) if unit == "ns" else c * 1000 if unit == "ms" else c


def to_nanos(c: Column, unit: str) -> Column:
    check_unit(unit)
    c = c.cast("bigint")
    return c * {"ns": 1, "us": 1000, "ms": 1_000_000}[unit] if unit != "ns" else c


def epoch_micros(c: Column, kind: str) -> Column:
    """Micros since 1970 of a column of type ``kind``: timestamp, timestamp_ntz or a number of micros."""
    if kind == "timestamp_ntz":  # no zone takes part in a difference of two of them; an interval gives whole seconds as a number
        since = c - F.lit("1970-01-01").cast("timestamp_ntz")
        seconds = since.cast("interval second").cast("bigint")
        below = (since - F.expr("interval '1' second") * seconds) * 1_000_000
        return seconds * 1_000_000 + below.cast("interval second").cast("bigint")
    return F.unix_micros(c) if kind == "timestamp" else c.cast("bigint")


def _iso_seconds(micros: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of micros; days and seconds of the day, so no time zone takes part."""
    seconds = F.floor(micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("bigint")
    day = F.floor(seconds / 86400).cast("int")
    rest = seconds - day.cast("bigint") * 86400
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    date = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), day), "yyyy-MM-dd")
    clock = (F.floor(rest / 3600), F.floor(rest % 3600 / 60), rest % 60)
    return F.concat(date, F.lit("T"), F.concat_ws(":", *map(two, clock)))


def iso_micros(micros: Column) -> Column:
    """ISO-8601 with six digits and Z."""
    part = F.pmod(micros, F.lit(1_000_000))
    return F.concat(_iso_seconds(micros), F.lit("."), F.lpad(part.cast("string"), 6, "0"), F.lit("Z"))


def iso_nanos(nanos: Column) -> Column:
    """ISO-8601 with nine digits and Z."""
    below = F.pmod(nanos, F.lit(1000).cast("bigint"))
    micros = whole_div(nanos - below, 1000)
    part = F.pmod(micros, F.lit(1_000_000)) * 1000 + below
    return F.concat(_iso_seconds(micros), F.lit("."), F.lpad(part.cast("string"), 9, "0"), F.lit("Z"))
