"""Interval algebra: union, clipping, calendars, recurring civil windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanworks.functions.arrays import let
from spanworks.functions.times import CIVIL_ZONE, civil_instant, clock_us, micros

DAY_US = 86_400_000_000


def union_intervals(df: DataFrame, keys: list[str], start: str = "s", end: str = "e", presplit_us: int | None = None) -> DataFrame:
    """Join intervals of a key that overlap or touch: ``keys``, ``start``, ``end``.

    One shuffle and one sort.  ``presplit_us`` first joins what starts in the same stretch of
    time, so that a key with very many intervals reaches its task as few.
    Bounds are longs (microseconds) or timestamps; ``presplit_us`` needs longs.
    """
    if presplit_us:
        part = union_intervals(df.withColumn("_cell", F.floor(F.col(start) / presplit_us)), [*keys, "_cell"], start, end)
        return union_intervals(part.drop("_cell"), keys, start, end)
    by = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1))
    numbered = opened.withColumn("_island", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def overlap_us(start: Column, end: Column, lo: Column, hi: Column) -> Column:
    """Microseconds that two half-open stretches share."""
    return F.greatest(F.lit(0).cast("bigint"), F.least(end, hi) - F.greatest(start, lo))


def person_us(us: Column, people: Column) -> Column:
    """Microseconds times people, as a decimal: a month of a few million people, or a sum over events, is beyond a long."""
    return us.cast("decimal(19,0)") * people.cast("decimal(18,0)")


def months(first: Column, last: Column) -> Column:
    """First days of the months from ``first`` to ``last``, both included."""
    return F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))


def month_slices(df: DataFrame, start: str = "s", end: str = "e") -> DataFrame:
    """One row per month that an interval touches: ``month``, ``lo``, ``hi`` and ``us`` shared with it.

    Bounds are microseconds; an interval meets only its own months, so no calendar is joined to all rows.
    """
    first = F.to_date(F.timestamp_micros(F.col(start)))
    last = F.to_date(F.timestamp_micros(F.greatest(F.col(start), F.col(end) - 1)))
    out = df.withColumn("month", F.explode(months(first, last)))
    return with_month_bounds(out).withColumn("us", overlap_us(F.col(start), F.col(end), F.col("lo"), F.col("hi"))).where("us > 0")


def with_month_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({"lo": micros(F.col("month")), "hi": micros(F.add_months("month", 1))})


def day_slices(df: DataFrame, start: str = "s", end: str = "e") -> DataFrame:
    """As :func:`month_slices`, by UTC day: ``day`` and ``us``."""
    first = F.to_date(F.timestamp_micros(F.col(start)))
    last = F.to_date(F.timestamp_micros(F.greatest(F.col(start), F.col(end) - 1)))
    out = df.withColumn("day", F.explode(F.sequence(first, last)))
    lo = micros(F.col("day"))
    return out.withColumn("us", overlap_us(F.col(start), F.col(end), lo, lo + 86_400_000_000)).where("us > 0")


def civil_windows(first: Column, opens: Column, closes: Column, lo: Column, hi: Column, zone: str = CIVIL_ZONE) -> Column:
    """An array of (s, e) instants in microseconds: a daily window in civil time, clipped to [lo, hi).

    Each date is converted by itself, so nights on which clocks change have their own
    length.  A window that closes before it opens ends on the next day; one that closes as it
    opens gives no windows.  ``lo`` and ``hi`` are timestamps.
    """
    from_day = F.greatest(first.cast("date"), F.to_date(F.from_utc_timestamp(lo - F.expr("interval 1 day"), zone)))
    to_day = F.to_date(F.from_utc_timestamp(hi, zone))
    # what holds for all days is worked out once; days that close before they open end a day later
    closing = clock_us(closes) + F.when(closes < opens, DAY_US).otherwise(0)
    row = F.struct(micros(lo).alias("lo"), micros(hi).alias("hi"), clock_us(opens).alias("opens"), closing.alias("closes"), F.sequence(F.unix_date(from_day), F.unix_date(F.greatest(from_day, to_day))).alias("days"))

    def one(x: Column, day: Column) -> Column:
        midnight = day.cast("bigint") * DAY_US
        s = F.greatest(civil_instant(midnight + x["opens"], zone), x["lo"])
        e = F.least(civil_instant(midnight + x["closes"], zone), x["hi"])
        return F.struct(s.alias("s"), e.alias("e"))

    found = let(row, lambda x: F.filter(F.transform(x["days"], lambda day: one(x, day)), lambda w: w["e"] > w["s"]))
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    return F.when((opens == closes) | (from_day > to_day), none).otherwise(found)


def in_force(start: Column, end: Column, now: Column) -> Column:
    """Whether an interval stands at ``now``; unlike elsewhere the end is included."""
    return (start <= now) & (now <= end)
