"""Times as epoch numbers, durations and ages. No function reads a clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_TIME = 1577836800  # 2020-01-01


def repair_time(t: Column, now: int, floor: bool = False) -> Column:
    """Seconds; over 1e10 are milliseconds; before 2020 or over a day ahead become now."""
    seconds = F.when(t > 10_000_000_000, F.floor(t / 1000) if floor else (t / 1000).cast("long")).otherwise(t)
    return F.when(seconds.isNull() | (seconds < FIRST_TIME) | (seconds > now + 86400), F.lit(now)).otherwise(seconds).cast("long")


def day(t: Column) -> Column:
    return F.date_format(F.timestamp_seconds(t), "yyyy-MM-dd")


def hour(t: Column) -> Column:
    return F.date_format(F.timestamp_seconds(t), "yyyy-MM-dd HH:00")


def ago(now: int, days: int = 0, weeks: int = 0, months: int = 0, years: int = 0) -> Column:
    """Epoch of now less weeks and days as spans and months and years by calendar."""
    t = F.timestamp_seconds(F.lit(now)) - F.expr(f"make_interval({years}, {months}, {weeks}, {days}, 0, 0, 0)")
    return F.unix_timestamp(t)


UNITS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def duration_seconds(text: Column) -> Column:
    """Sum of number-and-unit parts; null for -1 and 0, which mean none."""
    parts = F.regexp_extract_all(text, F.lit(r"-?[0-9]+(?:\.[0-9]+)?(?:ms|s|m|h|d|w)"), F.lit(0))
    unit = lambda p: F.regexp_extract(p, "([a-z]+)$", 1)
    factor = lambda p: F.element_at(F.create_map(*(F.lit(x) for kv in UNITS.items() for x in (kv[0], float(kv[1])))), unit(p))
    total = F.aggregate(parts, F.lit(0.0), lambda a, p: a + F.regexp_extract(p, r"^(-?[0-9]+(?:\.[0-9]+)?)", 1).cast("double") * factor(p))
    return F.when(~text.isin("-1", "0"), total)


def age(birth: Column, on: Column) -> Column:
    """Whole years, by month and day."""
    return F.year(on) - F.year(birth) - F.when(F.date_format(on, "MMdd") < F.date_format(birth, "MMdd"), 1).otherwise(0)


def after_seconds(ns: Column, seconds: Column) -> Column:
    """Nanoseconds later than seconds."""
    return ns > seconds.cast("long") * 1_000_000_000


def human_duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.format_string("%dh%dm%ds", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def rate(count: Column, ns: Column) -> Column:
    """Per second with two digits, N/A for no time."""
    return F.when(F.coalesce(ns, F.lit(0)) > 0, F.format_string("%.2f", count / (ns / 1e9))).otherwise("N/A")
