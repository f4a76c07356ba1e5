"""Queries over streams: tables that come in parts, one after the other, and their SQL in batch form."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanworks.operators import pairing
from spanworks.plans import bindings as B
from spanworks.session import ensure_checkpoints, remove_folder
from spanworks.sources.archive import BucketArchive
from spanworks.streaming import figures, keyed, merging, paired
from spanworks.streaming.windows import file_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def yearly(versions: DataFrame, years: range) -> list[DataFrame]:
    """The orders as observations of customers, a part for each year, stamped with it."""
    v = versions.withColumn("at", F.to_timestamp("start_date")).withColumn("seen", F.col("y").cast("string"))
    return [v.where(F.col("y") == y).select("id", "at", "seen", "k", "status", "start_date") for y in years]


def halves(df: DataFrame, at: str, cuts: list[int]) -> list[DataFrame]:
    """Rows by time, in a part up to each cut and one behind the last."""
    ends = [None, *cuts, None]
    return [df.where((F.lit(True) if a is None else F.col(at) >= a) & (F.lit(True) if b is None else F.col(at) < b)) for a, b in zip(ends, ends[1:])]


CUTS = [B.SINCE_US + k * 7 * 86_400_000_000 for k in (1, 2)]


def bind(versions: Callable, years: range, issues: Callable) -> None:
    """The queries that share their tables with the batch forms."""

    @query
    def keyed_upsert(spark, d):
        """Years of orders as a stream with a state for each customer; it ends as the archive does that merges them."""
        return keyed.current(keyed.records_of(spark, yearly(versions(spark, d), years), quiet_ms=100 * 366 * 86_400_000, late="400 days"))

    @query
    def case_transitions(spark, d):
        """What the stream has told of each year: new, seen, closed and reopened customers."""
        records = keyed.records_of(spark, yearly(versions(spark, d), years), quiet_ms=100 * 366 * 86_400_000, late="400 days")
        last = records.groupBy("id", "last_seen").agg(F.max_by("kind", "version").alias("kind"))
        return last.groupBy("last_seen", "kind").agg(F.count("*").alias("customers"))

    @query
    def bucketed_upsert(spark, d):
        """Years of orders merged into an archive in buckets, of which a batch rewrites those it touches."""
        base = f"{ensure_checkpoints(spark).rstrip('/')}/archive-{uuid.uuid4().hex}"
        archive = BucketArchive(spark, base, buckets=32)
        for k, (y, part) in enumerate(zip(years, yearly(versions(spark, d), years))):
            archive.merge(part.select("id", "status", "start_date", "k"), F.lit(str(y)), batch_id=k, order="k")
        out = archive.read().checkpoint()
        remove_folder(spark, base)
        return out

    @query
    def paired_streams(spark, d):
        """Issues and lifts as two streams: the first lift from two days before an issue to a fortnight behind it."""
        i, j = issues(spark, d)
        parts = zip(halves(i, "at", CUTS), halves(j, "at", CUTS))
        sides = [(a.withColumn("issued", F.timestamp_micros("at")).drop("at"), b.withColumn("lifted", F.timestamp_micros("at")).drop("at")) for a, b in parts]
        return paired.pairs_of(spark, sides, ["region", "scheme"]).select("id", F.unix_micros("lifted").alias("lift_at"))


@query
def stream_sessions(spark, d):
    """Notices of a user and type merged by session windows as they come, each with its own length as the gap."""
    n = B.notices(spark, d).select("user_id", "category", "s", "e")
    return merging.sessions_of(spark, halves(n, "s", CUTS), ["user_id", "category"])


@query
def sliding_panes(spark, d):
    """Windows of a day every hour, put together from hours that were counted once."""
    p = merging.panes(B.table(spark, d, "events"), ["event_type"], "ts", "1 hour", "value")
    out = merging.sliding(p, ["event_type"], "1 hour", 24)
    return out.select("event_type", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n", F.round("total", 2).alias("total"), "least", "most")


def _row(spark: SparkSession, found: dict) -> DataFrame:
    return spark.range(1).select(*[F.lit(found[c]).cast("bigint").alias(c) for c in ("n_rows", "n_without_key", "first_us", "horizon_us")])


def _keyless(events: DataFrame) -> DataFrame:
    return events.withColumn("key", F.when(F.col("user_id") % 7 != 0, F.col("user_id")))


@query
def build_figures(spark, d):
    """The figures of a build, taken while its rows are written."""
    base = f"{ensure_checkpoints(spark).rstrip('/')}/build-{uuid.uuid4().hex}"
    found = figures.written_with_figures(_keyless(B.table(spark, d, "events")), lambda t: t.write.parquet(base), "ts", "key")
    remove_folder(spark, base)
    return _row(spark, found)


@query
def stream_freshness(spark, d):
    """The same of a stream, from the progress of its batches."""
    return _row(spark, figures.stream_figures(_keyless(file_stream(spark, f"{d}/events.parquet")), "ts", "key"))


_FIGURES = "select count(*) as n_rows, count(*) filter (user_id % 7 = 0) as n_without_key, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as horizon_us from events"


def sql(n: str, union: Callable[[str, str, str], str], upserted: str, versions: str, issues: str) -> dict[str, str]:
    """The SQL, from the pieces that the batch forms' is made of."""
    return {
        "keyed_upsert": upserted,
        "bucketed_upsert": upserted,
        "case_transitions": f"""with {versions}, one as (select * from (select *, row_number() over (partition by id, y order by k desc) as r from v) where r = 1),
w as (select id, y, status = 'Open' is true as now_open, lag(y) over (partition by id order by y) is null as is_new, coalesce(lag(status) over (partition by id order by y) = 'Open', false) as was_open from one)
select cast(y as varchar) as last_seen, case when is_new then 'new' when was_open and not now_open then 'closed' when now_open and not was_open then 'reopened' else 'seen' end as kind, count(*) as customers from w group by all""",
        "paired_streams": issues + f" select p.* from p join n on n.id = p.id where lift_at <= n.s + {pairing.CAP_US}",
        "stream_sessions": f"""with {n}, t as (select * from n where e > s), {union('u', 't', 'user_id, category')} select u.*, count(*) as n from u join t on t.user_id = u.user_id and t.category = u.category and t.s between u.s and u.e - 1 group by all""",
        "sliding_panes": """with w as (select event_type, value, unnest(generate_series(date_trunc('hour', ts) - interval 23 hour, date_trunc('hour', ts), interval 1 hour)) as start from events)
select event_type, strftime(start, '%Y-%m-%d %H:%M') as start, count(*) as n, round(sum(value), 2) as total, min(value) as least, max(value) as most from w group by all""",
        "build_figures": _FIGURES,
        "stream_freshness": _FIGURES,
    }
