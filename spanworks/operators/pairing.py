"""Forward pairing of a notice with the first lift, with slack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLACK_US = 2 * 86_400_000_000
CAP_US = 14 * 86_400_000_000


def first_after(issues: DataFrame, lifts: DataFrame, keys: list[str], id_col: str = "id", at: str = "at", slack_us: int = SLACK_US) -> DataFrame:
    """(id, lift_at): the earliest lift of the same keys from ``slack_us`` before the issue on.

    Both sides are put in one order per key, latest first, and the lift last seen is each issue's: one
    shuffle and one sort, however many lifts a key has.  Null or empty keys never pair; repeated ids take the earliest lift of theirs.
    """
    good = F.lit(True)
    for k in keys:
        good = good & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    none = F.lit(None).cast(issues.schema[id_col].dataType)
    right = lifts.where(good).select(*keys, none.alias("_id"), F.col(at).alias("_t"), F.col(at).alias("_lift")).distinct()
    left = issues.where(good).select(*keys, F.col(id_col).alias("_id"), (F.col(at) - slack_us).alias("_t"), F.lit(None).cast("bigint").alias("_lift"))
    latest = Window.partitionBy(*keys).orderBy(F.desc("_t"), F.desc_nulls_last("_lift")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = left.union(right).withColumn("_next", F.min("_lift").over(latest)).where("_lift is null and _next is not null")
    return found.groupBy(F.col("_id").alias(id_col)).agg(F.min("_next").alias("lift_at"))


def charged_end(end: Column, start: Column, cap_us: int = CAP_US) -> Column:
    """The furthest that a notice may charge."""
    return F.least(end, start + F.lit(cap_us))


def paired_end(lift: Column, start: Column) -> Column:
    """A notice can't end before it began."""
    return F.greatest(lift, start)
