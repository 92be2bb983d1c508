"""Instants, New York wall time, bar date fields and period names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from candlewright.session import NEW_YORK

MICROS_PER_SECOND = 1_000_000


def instant(text: Column) -> Column:
    """ISO text with any UTC offset -> TIMESTAMP; text without an offset is UTC; junk -> null."""
    return text.try_cast("timestamp")


def wall(ts: Column, zone: str = NEW_YORK) -> Column:
    """Wall clock of an instant, carried as a TIMESTAMP of a UTC session."""
    return F.from_utc_timestamp(ts, zone)


def wall_date(ts: Column, zone: str = NEW_YORK) -> Column:
    return F.to_date(wall(ts, zone))


def from_wall(local: Column, zone: str = NEW_YORK) -> Column:
    """Instant of a wall clock value (TIMESTAMP or TIMESTAMP_NTZ)."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def instant_literal(wall_text: str, zone: str = NEW_YORK) -> Column:
    """A foldable instant, so that comparisons with it can be pushed into the scan."""
    return F.to_utc_timestamp(F.lit(wall_text).cast("timestamp"), zone)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def plus_micros(ts: Column, amount: Column | int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + (F.lit(amount) if isinstance(amount, int) else amount))


def floor_to(ts: Column, step_seconds: int) -> Column:
    step = step_seconds * MICROS_PER_SECOND
    return F.timestamp_micros(F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(step)))


def zone_gap_hours(ts: Column, zone: str, other: str = NEW_YORK) -> Column:
    """Hours by which the wall clock of ``zone`` is ahead of the one of ``other`` at an instant."""
    return (micros(wall(ts, zone)) - micros(wall(ts, other))) / F.lit(3600.0 * MICROS_PER_SECOND)


def offset_text(ts: Column, zone: str = NEW_YORK) -> Column:
    """ISO text with the zone's offset, for example ``2026-07-17 09:30:00-04:00``."""
    local = wall(ts, zone)
    minutes = F.floor((micros(local) - micros(ts)) / F.lit(60 * MICROS_PER_SECOND))
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    hours = F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0")
    rest = F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0")
    fraction = F.when(
        F.pmod(micros(ts), F.lit(MICROS_PER_SECOND)) != 0, F.date_format(local, ".SSSSSS")
    ).otherwise(F.lit(""))
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), fraction, sign, hours, F.lit(":"), rest)


def clock_text(ts: Column) -> Column:
    """``HH:mm`` on the New York clock."""
    return F.date_format(wall(ts), "HH:mm")


def second_text(ts: Column) -> Column:
    """``HH:mm:ss`` on the New York clock, for grids finer than a minute."""
    return F.date_format(wall(ts), "HH:mm:ss")


def bar_date(field: Column) -> Column:
    """Mixed bar-date field -> instant.

    Eight digits are a date (New York midnight), other digits are epoch seconds, and the rest is
    ``yyyyMMdd HH:mm:ss`` with an optional zone name (New York when absent).
    """
    text = F.trim(field)
    parts = F.split(text, r"\s+")
    zone = F.coalesce(F.get(parts, F.lit(2)), F.lit(NEW_YORK))
    local = F.try_to_timestamp(F.concat_ws(" ", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))), F.lit("yyyyMMdd HH:mm:ss"))
    day = F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    return (
        F.when(text.rlike(r"^\d{8}$"), from_wall(day))
        .when(text.rlike(r"^\d+$"), F.timestamp_seconds(text.try_cast("bigint")))
        .otherwise(F.to_utc_timestamp(local, zone))
    )


def bar_date_is_daily(field: Column) -> Column:
    return F.trim(field).rlike(r"^\d{8}$")


def label_text(ts: Column, daily: Column) -> Column:
    """``yyyy-MM-dd`` for a daily bar, ``yyyy-MM-dd HH:mm`` (New York) for an intraday bar."""
    return F.when(daily, F.date_format(wall(ts), "yyyy-MM-dd")).otherwise(F.date_format(wall(ts), "yyyy-MM-dd HH:mm"))


def epoch_to_wall(seconds: Column, zone: str = NEW_YORK) -> Column:
    """Unix seconds -> wall clock of a zone."""
    return wall(F.timestamp_seconds(seconds), zone)


def wall_to_epoch(local: Column, zone: str = NEW_YORK) -> Column:
    return F.unix_seconds(from_wall(local, zone))
