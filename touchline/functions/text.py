"""Cleaning of textual input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def lenient_int(text: Column) -> Column:
    """An integer, or NULL where the text is not one."""
    return F.trim(text).try_cast("int")


def message_key(season: Column, match_id: Column, *fallbacks: Column) -> Column:
    """`season:match_id`; the first non-NULL fallback stands in for a missing id."""
    identity = F.coalesce(match_id, *fallbacks) if fallbacks else match_id
    return F.concat(season, F.lit(":"), identity.cast("string"))


def iso_utc(ts: Column) -> Column:
    """ISO 8601 text with a UTC offset; microseconds only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    has_fraction = F.unix_micros(ts) % 1_000_000 != 0
    return F.concat(F.when(has_fraction, exact).otherwise(whole), F.lit("+00:00"))
