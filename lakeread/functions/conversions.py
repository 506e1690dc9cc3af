"""Scalar conversions between stored numbers and dates, timestamps and decimals; all stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ticks of a second.
UNITS = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}

#: The timestamp pattern of each precision.
TIMESTAMP_PATTERNS = ["yyyy-MM-dd HH:mm:ss"] + ["yyyy-MM-dd HH:mm:ss." + "S" * n for n in range(1, 7)]
DATE_PATTERNS = ["yyyy-MM-dd", "yyyyMMdd"]


def to_epoch(ts: Column, unit: str) -> Column:
    """Ticks since 1970 UTC; parts of a tick are cut off towards the past. Null stays null."""
    micros = F.unix_micros(ts.cast("timestamp"))
    if unit == "ns":
        return micros * 1_000
    return F.floor(micros / F.lit(UNITS["us"] // UNITS[unit]).cast("decimal(20,0)")).cast("long") if unit != "us" else micros


def from_epoch(ticks: Column, unit: str) -> Column:
    """The timestamp without zone, in UTC, of ticks since 1970; nanoseconds are cut to microseconds."""
    per = UNITS["us"] // UNITS[unit] if unit != "ns" else 0
    micros = ticks.cast("long") * per if per else F.floor(ticks.cast("decimal(38,0)") / 1_000).cast("long")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def to_epoch_day(day: Column) -> Column:
    return F.unix_date(day.cast("date"))


def from_epoch_day(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))


def rescale(value: Column, precision: int, scale: int) -> Column:
    """The value as decimal(precision, scale); an error if that would round it or doesn't fit."""
    to = value.try_cast(f"decimal({precision},{scale})")
    lost = value.isNotNull() & (to.isNull() | (to.cast("decimal(38,18)") != value.cast("decimal(38,18)")))
    return F.when(lost, F.raise_error(F.concat(F.lit("rounding needed: "), value.cast("string"))).cast(f"decimal({precision},{scale})")).otherwise(to)


def parse_date(text: Column) -> Column:
    """By the first of the two patterns that fits; null if none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(p)).cast("date") for p in DATE_PATTERNS))


def parse_timestamp(text: Column, precision: int) -> Column:
    """A timestamp without zone whose text has exactly `precision` fractional digits; null otherwise."""
    shape = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d" + (rf"\.\d{{{precision}}}$" if precision else "$")
    return F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(TIMESTAMP_PATTERNS[precision])).cast("timestamp_ntz"))


def format_timestamp(ts: Column, precision: int) -> Column:
    return F.date_format(ts, TIMESTAMP_PATTERNS[precision])
