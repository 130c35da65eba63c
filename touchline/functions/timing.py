"""Durations, ages and breach severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed


_MICROS = 1_000_000


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with microsecond resolution; NULL while either end is open."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(_MICROS))


def overrun(start: Column, end: Column, expected: Column) -> Column:
    """Seconds beyond the expected ones, subtracted as whole microseconds so that no digit is lost."""
    allowed = expected.cast("bigint") * _MICROS
    return (F.unix_micros(end) - F.unix_micros(start) - allowed) / F.lit(float(_MICROS))


def time_bucket(micros: Column, width: int) -> Column:
    """The number of the bucket of `width` microseconds that holds a time; exact, also before 1970."""
    return ((micros - F.pmod(micros, F.lit(width).cast("bigint"))) / width).cast("bigint")


def severity(actual: Column, expected: Column) -> Column:
    ratio = actual / F.greatest(expected, F.lit(1))
    return (
        F.when(ratio >= fixed.CRITICAL_RATIO, "critical")
        .when(ratio >= fixed.HIGH_RATIO, "high")
        .otherwise("warning")
    )


def breach_summary(stage: Column) -> Column:
    return F.format_string(fixed.BREACH_SUMMARY, stage)


def breach_text(stage: Column, actual: Column, expected: Column, over: Column) -> Column:
    return F.format_string(fixed.BREACH_TEXT, stage, actual, expected, over)
