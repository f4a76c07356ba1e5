"""Instants, civil time and spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CIVIL_ZONE = "Europe/Dublin"
LAST_SECOND = "23:59:59"


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of an instant; a timestamp without a zone counts as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def civil_to_utc(date: Column, time: Column, zone: str = CIVIL_ZONE) -> Column:
    """The instant of a civil date and HH:MM[:SS] time; null if either can't be read."""
    good = time.rlike(r"^\d{2}:\d{2}(:\d{2})?$") & date.cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$")
    full = F.concat(date.cast("string"), F.lit(" "), time, F.when(F.length(time) == 5, ":00").otherwise(""))
    return F.when(good, F.to_utc_timestamp(F.try_to_timestamp(full, F.lit("yyyy-MM-dd HH:mm:ss")), zone))


def clock_us(time: Column) -> Column:
    """Microseconds from midnight to HH:MM[:SS]; null where no clock shows it."""
    part = lambda k: F.substring(time, 3 * k + 1, 2).try_cast("int")
    h, m, s = part(0), part(1), F.when(F.length(time) == 5, 0).otherwise(part(2))
    good = time.rlike(r"^\d{2}:\d{2}(:\d{2})?$") & (h < 24) & (m < 60) & (s < 60)
    return F.when(good, (h * 3600 + m * 60 + s).cast("bigint") * 1_000_000)


def civil_instant(local_us: Column, zone: str = CIVIL_ZONE) -> Column:
    """The instant at which the zone's clocks show so many microseconds since 1970; no text is built or read."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_us), zone))


def reported_end(date: Column, time: Column, zone: str = CIVIL_ZONE) -> Column:
    """When a notice says it ends; a date without a time ends with its day."""
    return civil_to_utc(date, F.coalesce(time, F.lit(LAST_SECOND)), zone)


def span_seconds(start: Column, source: Column, date: Column, time: Column, zone: str = CIVIL_ZONE) -> Column:
    """Seconds from publication to the reported end: null without a real end, or if it lies before."""
    span = (micros(reported_end(date, time, zone)) - micros(start)) / 1e6
    return F.when(~F.coalesce(source, F.lit("not_found")).isin("not_found", "lifted_immediate") & (span >= 0), span)


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """The date of three numbers, null if the calendar has none."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def nearest_year(day: Column, month: Column, near: Column) -> Column:
    """The date of a day and month in the year that brings it nearest to ``near``; ties go to the earlier one."""
    years = F.array(*[F.year(near) + k for k in (-1, 0, 1)])
    dates = F.transform(years, lambda y: F.struct(F.abs(F.datediff(calendar_date(y, month, day), near)).alias("far"), calendar_date(y, month, day).alias("d")))
    return F.array_min(F.filter(dates, lambda x: x["d"].isNotNull()))["d"]
