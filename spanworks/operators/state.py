"""State: temporal upsert, replay of snapshots, guarded stamps, logs, stale rows, schema growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN = "Open"


def upsert(old: DataFrame, new: DataFrame, now: Column, key: str = "id", status: str = "status", start: str = "start_date", order: str | None = None) -> DataFrame:
    """Merge a batch into an archive by key and stamp transitions.

    Fed columns are those of ``new``; the stamps are first_seen, last_seen, closed_at and
    first_start_date.  Rows absent from the batch stay as they are.  A reopened row loses
    closed_at, an open row that is open no more gets ``now``; a null status counts as closed.
    The last of several batch rows of a key counts: that with the largest ``order``, a column beside the fed ones, else
    the last in the order of the batch's partitions and rows.
    """
    fed = [c for c in new.columns if c not in (key, order)]
    place = F.monotonically_increasing_id() if order is None else F.col(order)
    batch = new.withColumn("_place", place).groupBy(key).agg(F.max_by(F.struct(*fed), "_place").alias("_new"))
    stamps = ["first_seen", "last_seen", "closed_at", "first_start_date"]
    past = old.select(key, F.struct(*[c for c in old.columns if c != key]).alias("_old"))
    both = past.join(batch, key, "full_outer")
    came, had = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    pick = lambda c: F.when(came, F.col("_new")[c]).otherwise(F.col("_old")[c])
    is_open, was_open = F.col("_new")[status].eqNullSafe(OPEN), F.col("_old")[status].eqNullSafe(OPEN)
    closed = F.when(~came, F.col("_old.closed_at")).when(is_open, None).when(had & was_open, now).otherwise(F.col("_old.closed_at"))
    return both.select(
        key, *[pick(c).alias(c) for c in fed], F.coalesce("_old.first_seen", now).alias(stamps[0]), F.when(came, now).otherwise(F.col("_old.last_seen")).alias(stamps[1]),
        closed.alias(stamps[2]), F.coalesce(F.col("_old.first_start_date"), F.col("_new")[start]).alias(stamps[3]),
    )


def replay(snapshots: DataFrame, key: str = "id", tag: str = "tag", status: str = "status") -> DataFrame:
    """(key, closed_tag): the first snapshot after the last open one in which a row isn't open.

    Null statuses count as closed; being absent changes nothing; a row never open has no tag.
    Two aggregates, combined before the shuffle, instead of a walk over ordered rows.
    """
    is_open = F.col(status).eqNullSafe(OPEN)
    last = snapshots.where(is_open).groupBy(key).agg(F.max(tag).alias("_last"))
    later = snapshots.where(~is_open).join(last, key).where(F.col(tag) > F.col("_last"))
    return later.groupBy(key).agg(F.min(tag).alias("closed_tag"))


def apply_stamps(cases: DataFrame, stamps: DataFrame, key: str = "id", stamp: str = "closed_tag", target: str = "closed_at", status: str = "status") -> DataFrame:
    """Fill a stamp only where it is null and the row isn't open; ``filled`` tells where."""
    both = cases.join(stamps, key, "left")
    fill = F.col(target).isNull() & ~F.col(status).eqNullSafe(OPEN) & F.col(stamp).isNotNull()
    return both.withColumn("filled", fill).withColumn(target, F.when(fill, F.col(stamp)).otherwise(F.col(target))).drop(stamp)


def log_edge(log: DataFrame, key: str, at: str, line: str, latest: bool = True) -> DataFrame:
    """The latest (or first) record per key; of equal times the first line counts."""
    order = F.col(at).desc_nulls_last() if latest else F.col(at).asc_nulls_first()
    w = Window.partitionBy(key).orderBy(order, line)
    return log.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def stale(cases: DataFrame, recorded: DataFrame, key: str, fingerprint: str, version: Column | None = None, models: list[str] | None = None, force: bool = False) -> DataFrame:
    """Cases whose recorded fingerprint (or version) is missing or differs, or whose record is of none of the ``models``; with ``force`` all of them.

    ``recorded`` has a row per key at most: the fingerprint, and ``version`` and ``model`` where these are asked for.
    """
    if force:
        return cases
    more = {"version": "_v"} if version is not None else {}
    more |= {"model": "_m"} if models is not None else {}
    seen = recorded.select(key, F.col(fingerprint).alias("_was"), *[F.col(c).alias(n) for c, n in more.items()])
    both = cases.join(seen, key, "left")
    same = F.col(fingerprint).eqNullSafe(F.col("_was")) & F.col("_was").isNotNull()
    if version is not None:
        same = same & F.col("_v").eqNullSafe(version)
    if models is not None:
        same = same & F.coalesce(F.col("_m").isin(models), F.lit(False))
    return both.where(~same).drop("_was", "_v", "_m")


def never_matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_anti")


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: how many keys of ``left`` the right side lacks, and the least and largest of them."""
    return never_matched(left.select(key).distinct(), right, key).agg(F.count("*").alias("missing"), F.min(key).alias("least"), F.max(key).alias("most"))


def require_coverage(left: DataFrame, right: DataFrame, key: str) -> None:
    n, a, b = coverage(left, right, key).first()
    if n:
        raise ValueError(f"{n} keys are unknown, from {a} to {b}")


def evolve(df: DataFrame, schema: T.StructType, required: list[str]) -> DataFrame:
    """Bring an older table to a newer schema: additive nullable columns only."""
    lacking = [c for c in required if c not in df.columns]
    unknown = [c for c in df.columns if c not in schema.names]
    if lacking or unknown:
        raise ValueError(f"required columns are missing: {lacking}; columns newer than the code: {unknown}")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def fill_placeholders(cache: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows with null values for wanted keys that the cache lacks; cached rows are never touched."""
    new = wanted.select(*keys).distinct().join(cache, keys, "left_anti")
    return cache.unionByName(new, allowMissingColumns=True)
