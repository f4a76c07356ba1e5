"""Pushdown into the attribute source, whole runs of a log, the breaker over tasks, planned pages, figures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from spanworks.plans.hybrid import enrich
from spanworks.sources import attributes, logs, readers, replayed, sinks
from spanworks.streaming import figures

ROWS = [(k, "Mayo" if k % 3 else "O'Hara", "Open" if k % 2 else None) for k in range(100)]


@pytest.fixture
def service(spark, tmp_path):
    """A fetcher over a table, and the folder where each call leaves what it was asked and how many rows it gave."""
    spark.createDataFrame(ROWS, "k bigint, county string, status string").coalesce(3).write.parquet(f"{tmp_path}/t")
    os.mkdir(tmp_path / "calls")
    named = {"OBJECTID": ("k", None), "COUNTY": ("county", None), "STATUS": ("status", None)}
    pages = replayed.selected_pages(f"{tmp_path}/t", ["k", "county", "status"], named, lambda r: json.dumps({"attributes": {"OBJECTID": r["k"], "COUNTY": r["county"], "STATUS": r["status"]}}))
    calls = f"{tmp_path}/calls"

    def fetch(clauses, offset, size):
        got = pages(clauses, offset, size)
        with open(f"{calls}/{os.getpid()}-{os.urandom(4).hex()}", "w") as f:
            f.write(json.dumps([attributes.where_text(clauses), size, len(got["features"])]))
        return got

    def seen():
        out = [json.loads(open(f"{calls}/{x}").read()) for x in os.listdir(calls)]
        for x in os.listdir(calls):
            os.remove(f"{calls}/{x}")
        return out

    return fetch, seen


def test_predicates_go_into_the_request(spark, service):
    fetch, seen = service
    df = attributes.read_attributes(spark, fetch, size=10).where("COUNTY = 'O''Hara' and OBJECTID >= 50").select("OBJECTID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ") Filter (" not in plan, plan
    assert sorted(r[0] for r in df.collect()) == [k for k, c, _ in ROWS if c == "O'Hara" and k >= 50]
    calls = seen()
    assert {c[0] for c in calls} == {"COUNTY IS NOT NULL AND OBJECTID IS NOT NULL AND COUNTY = 'O''Hara' AND OBJECTID >= 50"}
    assert sum(n for _, size, n in calls if size == 10) == 17, "no row is fetched that isn't asked for"
    # what the service can't answer stays with Spark, and nulls never match
    some = attributes.read_attributes(spark, fetch, size=40).where("STATUS in ('Open', 'x') and OBJECTID % 5 = 0 and TITLE is null and COUNTY <> 'x'")
    assert ") Filter (" in some._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.OBJECTID for r in some.collect()) == [5, 15, 25, 35, 45, 55, 65, 75, 85, 95]
    assert all("STATUS IN ('Open', 'x')" in c[0] and "%" not in c[0] for c in seen())
    assert attributes.read_attributes(spark, fetch, size=200, one_page="true").count() == 100
    with pytest.raises(Exception, match="more than one page"):
        attributes.read_attributes(spark, fetch, size=50, one_page="true").collect()


def test_clauses():
    from pyspark.sql.datasource import EqualTo, In, StringStartsWith

    assert attributes.clause_of(EqualTo(("COUNTY",), "Mayo")) == ("COUNTY", "=", "Mayo")
    assert attributes.clause_of(In(("OBJECTID",), (1, 2))) == ("OBJECTID", "in", (1, 2))
    assert [attributes.clause_of(f) for f in (EqualTo(("COUNTY",), 5), EqualTo(("nope",), "x"), EqualTo(("COUNTY", "x"), "y"), StringStartsWith(("COUNTY",), "M"), In(("OBJECTID",), (1, None)))] == [None] * 5
    assert attributes.where_text(()) == "1=1"


def test_pages_are_planned(spark, tmp_path):
    spark.range(0, 2345, 1, 3).write.parquet(f"{tmp_path}/t")
    fetch = replayed.pages_of(f"{tmp_path}/t", ["id"], lambda r: json.dumps(r))
    asked = []

    def counted(offset, size):
        asked.append(size)
        return fetch(offset, size)

    readers.FeedSource.fetchers["planned"] = counted
    reader = readers.FeedSource({"fetch": "planned", "size": "100"}).reader(None)
    parts = reader.partitions()
    assert len(parts) == 24 and set(asked) == {1} and len(asked) <= 12
    rows = [json.loads(r[0])["id"] for p in parts for r in reader.read(p)]
    assert rows == list(range(2345)) or sorted(rows) == list(range(2345))


def test_stream_offsets(spark, tmp_path):
    """Rows that a feed gains between triggers come once, and a batch that is run again has the same rows."""
    size = [7]
    readers.FeedSource.fetchers["grows"] = lambda offset, n: {"features": [str(k) for k in range(offset, min(offset + n, size[0]))], "exceededTransferLimit": offset + n < size[0]}
    stream = readers.FeedSource({"fetch": "grows", "size": "3"}).streamReader(None)
    read = lambda a, b: [int(r[0]) for p in stream.partitions(a, b) for r in stream.read(p)]
    at = [stream.initialOffset(), stream.latestOffset()]
    size[0] = 20
    at.append(stream.latestOffset())
    assert at == [{"rows": 0}, {"rows": 7}, {"rows": 20}] and stream.latestOffset() == {"rows": 20}
    assert read(at[0], at[1]) == list(range(7)) == read(at[0], at[1]) and read(at[1], at[2]) == list(range(7, 20))
    size[0] = 10
    with pytest.raises(ValueError, match="shrunk"):
        read(at[1], at[2])
    size[0] = 0
    assert readers.FeedSource({"fetch": "grows"}).streamReader(None).latestOffset() == {"rows": 0}


SAID = "k bigint, said string"


def test_runs_are_whole(spark, tmp_path):
    path = f"{tmp_path}/log"
    df = spark.range(0, 40, 1, 4).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.concat(F.lit('é "\n'), F.col("id").cast("string"))).alias("said"))
    assert logs.read_runs(spark, path, SAID).count() == 0
    # a task that fails leaves no record
    fails = df.withColumn("said", F.when(F.col("k") == 33, F.raise_error(F.lit("no"))).otherwise(F.col("said")))
    with pytest.raises(Exception, match="no"):
        logs.append_run(fails, path, "one")
    assert logs.read_runs(spark, path, SAID).count() == 0 and not logs.has_run(path, "one")
    # a retry has no duplicate, and a run that comes again adds nothing
    assert logs.append_run(df, path, "one") and not logs.append_run(df, path, "one")
    assert logs.append_run(df.limit(0), path, "none") and logs.append_run(df.where("k < 3"), path, "two")
    got = sorted(map(tuple, logs.read_runs(spark, path, SAID).collect()))
    assert got == sorted([*map(tuple, df.collect()), *map(tuple, df.where("k < 3").collect())])
    # of two writers of one run the second adds nothing
    writer = logs._LogWriter(path, "one", ["k", "said"])
    writer.commit([writer.write(iter([(1, "x")]))])
    assert logs.read_runs(spark, path, SAID).count() == 43
    for name in ("", "a/b", "../x"):
        with pytest.raises(ValueError, match="run"):
            logs._LogWriter(path, name, [])


@pytest.mark.parametrize("workers", [1, 2, 6])
def test_one_breaker_for_all_tasks(spark, tmp_path, workers):
    calls = f"{tmp_path}/calls"
    os.mkdir(calls)

    def look(k):
        open(f"{calls}/{k}-{os.urandom(4).hex()}", "w").close()
        if k >= 0:
            raise OSError("down")
        return "{}"

    dead = spark.range(500).withColumnRenamed("id", "k")
    with pytest.raises(Exception, match="in a row"):
        enrich(dead, ["k"], look, give_up=12, workers=workers)
    per_attempt = 12 + workers
    assert 12 <= len(os.listdir(calls)) <= 4 * per_attempt, "an attempt of the stage asks a bounded number of times"
    alive = dead.select((-F.col("k") - 1).alias("k")).union(spark.range(2).select(F.col("id").alias("k"))).union(spark.range(1).select(F.lit(-1).cast("bigint")))
    got = {r.k: r.raw_json for r in enrich(alive, ["k"], look, give_up=12, workers=workers).collect()}
    assert len(got) == 502 and got[-1] == "{}" and "failed" in got[0] and "failed" in got[1]
    assert enrich(dead.limit(0), ["k"], look, workers=workers).count() == 0


def test_figures_as_rows_pass(spark, tmp_path):
    df = spark.range(0, 50, 1, 3).select(F.when(F.col("id") > 3, F.col("id")).alias("k"), F.timestamp_micros(F.col("id") * 1_000_000).alias("at"))
    want = {"n_rows": 50, "n_without_key": 4, "first_us": 0, "horizon_us": 49_000_000}
    assert figures.written_with_figures(df, lambda t: t.write.parquet(f"{tmp_path}/a"), "at", "k") == want
    listener = figures.Freshness()
    spark.streams.addListener(listener)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/a")
    assert figures.stream_figures(stream, "at", "k") == want
    for _ in range(50):
        if listener.of.get("build", {}).get("n_rows") == 50:
            break
        import time

        time.sleep(0.2)
    spark.streams.removeListener(listener)
    assert listener.of["build"] == want
    assert figures.written_with_figures(df.limit(0), lambda t: t.write.parquet(f"{tmp_path}/b"), "at", "k") == {"n_rows": 0, "n_without_key": 0, "first_us": None, "horizon_us": None}


def test_a_round_whose_name_is_claimed_takes_the_next(spark, tmp_path, monkeypatch):
    k = spark.range(3).withColumnRenamed("id", "case_id")
    path = f"{tmp_path}/round"
    # another run has the name between this one's look and its claim
    (tmp_path / "round").mkdir()
    (tmp_path / "round" / sinks.CLAIM).touch()
    real, first = sinks.exists, [True]
    monkeypatch.setattr(sinks, "exists", lambda s, p: False if p == path and first and first.pop() else real(s, p))
    assert sinks.new_round(k, path) == f"{path}_r2"
    assert sinks.new_round(k, path) == f"{path}_r3"
    assert spark.read.option("header", True).csv(f"{path}_r2").count() == 3


def test_a_round_that_fails_gives_its_name_back(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception):
        sinks.new_round(bad, f"{tmp_path}/round")
    assert sinks.new_round(spark.range(3), f"{tmp_path}/round") == f"{tmp_path}/round"
