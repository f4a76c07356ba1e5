"""Keyed state, paired streams, merging windows and the bucketed archive against their batch forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spanworks.operators import intervals, pairing, state
from spanworks.streaming import keyed, merging, paired

H = 3_600_000_000
SEEN = "id bigint, at timestamp, seen string, k bigint, status string, start_date string"


def observed(rows):
    return [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=10 * s), f"s{s:02}", k, status, f"d{k}") for i, s, k, status in rows]


def archive_of(spark, rows):
    """The batch upsert, one stamp after the other."""
    whole = spark.createDataFrame(observed(rows), SEEN)
    out = None
    for s in sorted({r[2] for r in observed(rows)}):
        new = whole.where(F.col("seen") == s).select("id", "status", "start_date", "k")
        if out is None:
            out = new.limit(0).drop("k").selectExpr("*", *[f"cast(null as string) {c}" for c in ("first_seen", "last_seen", "closed_at", "first_start_date")])
        out = state.upsert(out, new, F.lit(s), order="k")
    return sorted(tuple(r[c] for c in ("id", "status", "start_date", "first_seen", "last_seen", "closed_at", "first_start_date")) for r in out.collect())


def as_rows(df):
    return sorted(tuple(r[c] for c in ("id", "status", "start_date", "first_seen", "last_seen", "closed_at", "first_start_date")) for r in df.collect())


def drawn(seed, n=300):
    draw = random.Random(seed)
    return [(draw.randint(0, 25), draw.randint(0, 5), k, draw.choice(["Open", "Closed", None])) for k in range(n)]


def test_fold_is_the_upsert(spark):
    rows = drawn(3)
    cases = {}
    for i, s, k, status in sorted(rows, key=lambda r: (r[1], r[2])):
        cases[i], _ = keyed.fold(cases.get(i), f"s{s:02}", k, status, f"d{k}")
    got = sorted((i, c["status"], c["start_date"], c["first_seen"], c["stamp"], c["closed_at"], c["first_start_date"]) for i, c in cases.items())
    assert got == archive_of(spark, rows)


def test_keyed_state_over_batches(spark):
    rows = drawn(4, 120)
    parts = [spark.createDataFrame(observed([r for r in rows if r[1] in some]), SEEN) for some in ((0, 1), (2,), (3, 4, 5))]
    records = keyed.records_of(spark, parts, late="20 days", quiet_ms=10**12)
    assert as_rows(keyed.current(records)) == archive_of(spark, rows)
    assert {r.kind for r in records.select("kind").distinct().collect()} <= {"new", "seen", "closed", "reopened"}


def test_keyed_state_resumes(spark, tmp_path):
    """A run that dies after its batch was worked on, and before it was marked done, is taken up without a second record."""
    rows = [(1, 0, 1, "Open"), (2, 0, 2, "Open"), (1, 1, 3, "Closed"), (2, 2, 4, "Open"), (1, 3, 5, "Open")]
    dies = [False]

    def put(b, k):
        b.write.mode("overwrite").parquet(f"{tmp_path}/records/batch={k}")
        if dies[0]:
            raise RuntimeError("killed")

    def run():
        before = spark.conf.get(keyed._PROVIDER)
        spark.conf.set(keyed._PROVIDER, keyed._ROCKS)
        records = keyed.track(spark.readStream.schema(SEEN).parquet(f"{tmp_path}/in"), late="20 days", quiet_ms=10**12)
        q = records.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        spark.conf.set(keyed._PROVIDER, before)
        q.awaitTermination()

    for n, part in enumerate((rows[:2], rows[2:4], rows[4:])):
        spark.createDataFrame(observed(part), SEEN).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        dies[0] = n == 1
        if dies[0]:
            with pytest.raises(Exception, match="killed"):
                run()
            dies[0] = False
        run()
    records = spark.read.parquet(f"{tmp_path}/records").drop("batch")
    assert as_rows(keyed.current(records)) == archive_of(spark, rows)
    versions = sorted((r.id, r.version, r.kind) for r in records.collect())
    assert versions == [(1, 1, "new"), (1, 2, "closed"), (1, 3, "reopened"), (2, 1, "new"), (2, 2, "seen")]


def test_silent_cases_lapse(spark):
    first = observed([(1, 0, 1, "Open"), (2, 0, 2, "Open"), (3, 0, 3, "Closed"), (None, 0, 4, "Open")])
    later = [observed([(2, s, 10 + s, "Open")]) for s in (3, 8, 12)]
    records = keyed.records_of(spark, [spark.createDataFrame(x, SEEN) for x in (first, *later)], late="1 day", quiet_ms=60 * 86_400_000).collect()
    assert [(r.id, r.version) for r in records if r.kind == "lapsed"] == [(1, 2)]
    assert {r.id for r in records} == {1, 2, 3}


ISSUE, LIFT = "id bigint, region bigint, scheme string, at bigint", "region bigint, scheme string, at bigint"
DAY = 24 * H


def sides(spark, issues, lifts):
    i, j = spark.createDataFrame(issues, ISSUE), spark.createDataFrame(lifts, LIFT)
    return i.withColumn("issued", F.timestamp_micros("at")).drop("at"), j.withColumn("lifted", F.timestamp_micros("at")).drop("at")


def test_paired_streams_are_the_batch_pairing(spark):
    draw = random.Random(8)
    issues = [(k, draw.randint(0, 2), draw.choice(["a", "b", "", None]), draw.randint(1, 40) * DAY // 2) for k in range(80)]
    lifts = [(draw.randint(0, 2), draw.choice(["a", "b", "", None]), draw.randint(0, 60) * DAY // 2) for _ in range(40)]
    parts = []
    for lo in range(0, 40, 10):
        of = lambda rows, n: [r for r in rows if lo * DAY <= r[n] < (lo + 10) * DAY]  # noqa: E731, B023
        parts.append(sides(spark, of(issues, 3), of(lifts, 2)))
    got = {r.id: r.us for r in paired.pairs_of(spark, parts, ["region", "scheme"]).select("id", F.unix_micros("lifted").alias("us")).collect()}
    whole = pairing.first_after(spark.createDataFrame(issues, ISSUE), spark.createDataFrame(lifts, LIFT), ["region", "scheme"])
    at = {k: a for k, _, _, a in issues}
    assert got and got == {r.id: r.lift_at for r in whole.collect() if r.lift_at <= at[r.id] + 14 * DAY}


def test_late_rows_pair_with_nothing(spark):
    issue, lift = (lambda k, d: (k, 1, "a", d * DAY)), (lambda d: (1, "a", d * DAY))
    parts = [([issue(1, 10)], [lift(1)]), ([issue(2, 60)], [lift(61)]), ([issue(3, 62)], [lift(63)]), ([issue(4, 11)], [lift(12)]), ([issue(5, 64)], [lift(65)])]
    got = {r.id: (r.us - 0) // DAY for r in paired.pairs_of(spark, [sides(spark, *p) for p in parts], ["region", "scheme"]).select("id", F.unix_micros("lifted").alias("us")).collect()}
    # issue 1 waits for a lift that comes too late, issue 4 comes too late itself
    assert got == {2: 61, 3: 61, 5: 63}


def test_sessions_are_the_union(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "b"]), s := draw.randint(0, 400) * H, s + draw.choice([0, 1, 2, 3]) * H) for _ in range(150)]
    rows += [("c", 0, H), ("c", H, 2 * H), ("c", 2 * H + 1, 3 * H), ("c", 50 * H, 60 * H), ("c", 51 * H, 52 * H)]  # the first two touch
    df = spark.createDataFrame(rows, "k string, s bigint, e bigint")
    want = sorted(map(tuple, intervals.union_intervals(df.where("e > s"), ["k"]).select("k", "s", "e").collect()))
    assert sorted(map(tuple, merging.sessions(df, ["k"]).select("k", "s", "e").collect())) == want
    parts = [df.where((F.col("s") >= lo * H) & (F.col("s") < (lo + 100) * H)) for lo in range(0, 500, 100)]
    got = merging.sessions_of(spark, parts, ["k"]).collect()
    assert sorted((r.k, r.s, r.e) for r in got) == want and sum(r.n for r in got) == sum(e > s for _, s, e in rows)


def test_sliding_by_panes(spark):
    draw = random.Random(1)
    rows = [(draw.choice("ab"), draw.randint(0, 40 * 60), float(draw.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, m int, v double").withColumn("at", F.expr("timestamp '2024-01-01' + m * interval 1 minute"))
    got = merging.sliding(merging.panes(df, ["k"], "at", "1 hour", "v"), ["k"], "1 hour", 6)
    want = df.groupBy(F.window("at", "6 hours", "1 hour").alias("w"), "k").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most")).select("k", F.col("w.start").alias("start"), "n", "total", "least", "most")
    assert sorted(map(tuple, got.select("k", "start", "n", "total", "least", "most").collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="slide"):
        merging.sliding(df, ["k"], "1 hour", 0)


CASE = "id bigint, status string, start_date string"


def test_archive_rewrites_what_a_batch_touches(spark, tmp_path):
    from spanworks.sources.archive import ArchiveMoved, BucketArchive, archive_batches

    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "a/data").rglob("*.parquet")}
    a = BucketArchive(spark, f"{tmp_path}/a", buckets=8)
    assert a.read() is None
    assert a.merge(spark.range(200).selectExpr("id", "'Open' status", "'d' start_date"), F.lit("t0"), batch_id=0) == 8
    before, old = files(), a.state()["versions"]
    assert a.merge(spark.createDataFrame([(5, "Closed", "e")], CASE), F.lit("t1"), batch_id=1) == 1
    new = a.state()["versions"]
    (moved,) = [b for b in new if new[b] != old[b]]
    assert {p: t for p, t in files().items() if f"bucket={moved}/" not in p} == {p: t for p, t in before.items() if f"bucket={moved}/" not in p}
    rows = {r.id: r for r in a.read().collect()}
    assert len(rows) == 200 and (rows[5].closed_at, rows[5].first_seen, rows[6].last_seen) == ("t1", "t0", "t0")
    assert set(a.read().columns) == {"id", "status", "start_date", "first_seen", "last_seen", "closed_at", "first_start_date"}
    # a batch that is run again changes nothing, an empty one only the number
    assert a.merge(spark.createDataFrame([(5, "Open", "e")], CASE), F.lit("t2"), batch_id=1) == 0
    assert a.merge(spark.createDataFrame([], CASE), F.lit("t2"), batch_id=2) == 0 and a.state()["number"] == 2
    # a writer that was overtaken fails and what it wrote is in no state
    stale = a.state() | {"number": 2}
    with pytest.raises(ArchiveMoved):
        a._publish(stale)
    assert a.vacuum() == 1 and a.read().count() == 200
    with pytest.raises(ValueError, match="8 buckets"):
        BucketArchive(spark, f"{tmp_path}/a", buckets=4).read()
    # as a stream's sink
    b = BucketArchive(spark, f"{tmp_path}/b", buckets=4)
    for part in ([(1, "Open", "x"), (2, "Open", "x")], [(1, "Closed", "y")]):
        spark.createDataFrame(part, CASE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        archive_batches(spark.readStream.schema(CASE).parquet(f"{tmp_path}/in"), b, lambda e: F.lit(f"t{e}")).awaitTermination()
    assert sorted((r.id, r.status, r.closed_at) for r in b.read().collect()) == [(1, "Closed", "t1"), (2, "Open", None)]
