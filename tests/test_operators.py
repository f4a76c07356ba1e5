"""Operators on small inputs with known answers."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from spanworks.functions import geo, text, times
from spanworks.operators import areas, categories, evaluation, intervals, ordered, pairing, severity, spatial, state
from spanworks.operators.rollup import modal

UTC = dt.timezone.utc


def test_running_matches_a_plain_window(spark):
    random.seed(3)
    data = [("hot" if random.random() < 0.7 else random.choice([None, "a", "b"]), random.randint(0, 50), random.randint(0, 9)) for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, o int, m int")
    got = ordered.running(df, ["k"], ["o"], {"before": F.col("m")}, number="no").collect()
    for k in ("hot", "a", None):
        mine = sorted((r for r in got if r.k == k), key=lambda r: r.no)
        assert [r.no for r in mine] == list(range(len(mine)))
        total, last = 0, -1
        for r in mine:
            assert r.before == total and r.o >= last
            total, last = total + r.m, r.o
    assert ordered.running(df.limit(0), ["k"], ["o"]).count() == 0


def test_union_matches_a_grid(spark):
    random.seed(5)
    data = [(k, s := random.randint(0, 80), s + random.randint(0, 9)) for k in range(40) for _ in range(random.randint(1, 12))]
    df = spark.createDataFrame(data, "k int, s bigint, e bigint")
    for pre in (None, 10):
        got = intervals.union_intervals(df, ["k"], presplit_us=pre).collect()
        for k in range(40):
            cells = {c for kk, s, e in data if kk == k for c in range(s, e)}
            mine = sorted((r.s, r.e) for r in got if r.k == k)
            assert sum(e - s for s, e in mine) == len(cells)
            assert all(a[1] < b[0] for a, b in zip(mine, mine[1:])), "touching intervals join"


def windows(spark, first, opens, closes, lo, hi):
    df = spark.sql(f"select date'{first}' d, '{opens}' o, '{closes}' c, timestamp'{lo}' lo, timestamp'{hi}' hi")
    w = df.select(intervals.civil_windows(F.col("d"), F.col("o"), F.col("c"), F.col("lo"), F.col("hi")).alias("w")).first().w
    return len(w), sum(x.e - x.s for x in w) / 3.6e9


def test_civil_windows(spark):
    assert windows(spark, "2026-07-09", "22:00", "07:00", "2026-07-09 08:00:00", "2026-07-27 06:00:00") == (18, 162.0)
    assert windows(spark, "2026-03-28", "22:00", "07:00", "2026-03-28 12:00:00", "2026-03-29 12:00:00") == (1, 8.0)
    assert windows(spark, "2026-10-24", "22:00", "07:00", "2026-10-24 12:00:00", "2026-10-25 12:00:00") == (1, 10.0)
    assert windows(spark, "2026-05-01", "09:00", "09:00", "2026-05-01 00:00:00", "2026-05-05 00:00:00") == (0, 0)


def test_civil_time_and_spans(spark):
    df = spark.sql("select timestamp'2026-06-01 10:00:00' s, '2026-06-01' d, '12:00' t, cast(null as string) none")
    r = df.select(
        times.span_seconds(F.col("s"), F.lit("completion_update"), F.col("d"), F.col("t")).alias("summer"),
        times.span_seconds(F.col("s"), F.lit("not_found"), F.col("d"), F.col("t")).alias("no"),
        times.span_seconds(F.col("s"), F.lit("completion_update"), F.lit("2026-05-31"), F.col("t")).alias("negative"),
        times.reported_end(F.lit("2026-03-29"), F.lit("01:30")).alias("gap"), times.reported_end(F.lit("2026-01-05"), F.col("none")).alias("day"), times.reported_end(F.col("d"), F.lit("10pm")).alias("bad"),
    ).first()
    assert (r.summer, r.no, r.negative, r.bad) == (3600.0, None, None, None)
    assert r.gap is not None and r.day == dt.datetime(2026, 1, 5, 23, 59, 59)


def test_nearest_year(spark):
    r = spark.sql("select date'2026-12-20' n").select(times.nearest_year(F.lit(5), F.lit(1), F.col("n")).alias("a"), times.nearest_year(F.lit(30), F.lit(2), F.col("n")).alias("b")).first()
    assert r.a == dt.date(2027, 1, 5) and r.b is None


@pytest.mark.parametrize(
    "cat, kind, restricted, recurring, want",
    [("burst_main", "Unplanned", None, False, "outage"), ("burst_main", "Planned", None, True, "degraded"), ("mains_repair", "Planned", None, False, "maintenance"), ("mains_repair", None, None, False, "outage"),
     ("boil_notice_issued", None, 1, False, "quality"), ("boil_notice_lifted", None, None, False, None), ("other", None, 1, False, "degraded"), (None, None, 0, False, "maintenance")],
)
def test_severity(spark, cat, kind, restricted, recurring, want):
    df = spark.createDataFrame([(cat, kind, restricted, None, recurring)], "c string, w string, r int, p int, x boolean")
    assert df.select(severity.severity(F.col("c"), F.col("w"), F.col("r"), F.col("p"), F.col("x"))).first()[0] == want


def test_grades(spark):
    df = spark.createDataFrame([(x,) for x in (100.0, 99.9, 99.8999, 99.75, 99.45, 99.0, 98.9, -3.0)], "a double")
    assert [r[0] for r in df.select(severity.grade(F.col("a"))).collect()] == list("AABBCDFF")


def test_radius_join_matches_brute_force(spark):
    import math

    random.seed(1)
    pins = [(i, 53 + random.random() / 3, -7 + random.random() / 3) for i in range(150)] + [(999, 40.0, 3.0)]
    spots = [(i, 53 + random.random() / 3, -7 + random.random() / 3) for i in range(120)]
    got = {}
    for r in spatial.affected(spark.createDataFrame(pins, "pin long, lat double, lon double"), spark.createDataFrame(spots, "area long, lat double, lon double"), 1.0, 3.0).collect():
        got.setdefault(r.pin, set()).add(r.area)
    for p, la, lo in pins:
        km = {a: math.hypot((y - la) * 111, (x - lo) * 111 * math.cos(math.radians(la))) for a, y, x in spots}
        near = {a for a, d in km.items() if d <= 1.0}
        best = min(km, key=lambda a: (km[a], a))
        assert got.get(p, set()) == (near or ({best} if km[best] <= 3.0 else set()))


def test_mercator(spark):
    r = spark.range(1).select(*[c.alias(n) for c, n in zip([*geo.mercator_to_lonlat(F.lit(-697000.0), F.lit(7047000.0)), *geo.mercator_to_lonlat(F.lit(0.0), F.lit(0.0))], "abcd")]).first()
    assert (round(r.a, 5), round(r.b, 5), r.c, r.d) == (-6.26126, 53.34462, 0.0, 0.0)


def test_pairing_takes_the_first_with_slack(spark):
    day = 86_400_000_000
    issues = spark.createDataFrame([(1, "k", 10 * day), (2, "", 10 * day), (3, "x", 10 * day)], "id long, k string, at long")
    lifts = spark.createDataFrame([("k", 7 * day), ("k", 9 * day), ("k", 20 * day), ("", 11 * day), ("x", 1 * day)], "k string, at long")
    assert [tuple(r) for r in pairing.first_after(issues, lifts, ["k"]).collect()] == [(1, 9 * day)]


def test_modal_tie(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", 1), ("b", None), ("b", 5)], "k string, v int")
    assert {r.k: r.v for r in modal(df, ["k"], ["v"]).collect()} == {"a": 1, "b": None}


CASE = "id long, status string, start_date string"


def test_upsert_sequences(spark):
    empty = spark.createDataFrame([], CASE + ", first_seen string, last_seen string, closed_at string, first_start_date string")

    def after(*batches):
        a = empty
        for k, rows in enumerate(batches):
            a = state.upsert(a, spark.createDataFrame(rows, CASE), F.lit(f"t{k}"))
        return {r.id: r for r in a.collect()}

    r = after([(1, "Open", "a"), (2, "Closed", "a"), (3, None, "a")], [(1, "Closed", "b"), (2, "Closed", "b")], [(1, None, "c")])
    assert (r[1].closed_at, r[1].first_seen, r[1].last_seen, r[1].first_start_date, r[1].start_date) == ("t1", "t0", "t2", "a", "c")
    assert (r[2].closed_at, r[3].last_seen) == (None, "t0")
    assert after([(1, "Open", "a")], [(1, "Closed", "a")], [(1, "Open", "a")])[1].closed_at is None


def test_replay_matches_a_walk(spark):
    import itertools

    seqs = list(itertools.product(["Open", "Closed", None, "absent"], repeat=4))
    rows = [(i, f"t{k}", s) for i, q in enumerate(seqs) for k, s in enumerate(q) if s != "absent"]
    got = {r.id: r.closed_tag for r in state.replay(spark.createDataFrame(rows, "id long, tag string, status string")).collect()}
    for i, q in enumerate(seqs):
        seen, closed = False, None
        for k, s in enumerate(q):
            if s == "Open":
                seen, closed = True, None
            elif s != "absent" and seen and closed is None:
                closed = f"t{k}"
        assert got.get(i) == closed


def test_schema_growth(spark):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("id", T.LongType()), T.StructField("new", T.StringType())])
    assert state.evolve(spark.createDataFrame([(1,)], "id long"), want, ["id"]).columns == ["id", "new"]
    with pytest.raises(ValueError):
        state.evolve(spark.createDataFrame([(1,)], "x long"), want, ["id"])
    with pytest.raises(ValueError, match="2 keys are unknown, from 2 to 3"):
        state.require_coverage(spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(1,)], "k int"), "k")


def test_text_columns(spark):
    one = lambda c, **kw: spark.range(1).select(c).first()[0]
    assert one(text.scheme_key(F.lit("Ardfinnan Regional Public Water Supply"))) == "ardfinnan"
    assert one(text.title_case(F.lit("o'BRIENSBRIDGE/cabra-glasnevin"))) == "O'Briensbridge/Cabra-Glasnevin"
    assert one(text.category_prefix(F.lit("Burst  Water Main– Co - Carlow"))) == "burst water main"
    assert one(text.strip_markup(F.lit("<p>a b</p>\n<b>c</b>"))) == "a b c"
    assert one(text.describes_recurrence(F.lit("<p>Nightly works"))) and not one(text.describes_recurrence(F.lit("dailyish")))
    assert one(text.event_key(F.lit(""), F.lit(7))) == "id:7"
    assert one(text.quotes(F.lit("from 9pm"), text.time_spellings(F.lit("21:00")))) and not one(text.quotes(F.lit("from 9am"), text.time_spellings(F.lit("21:00"))))


def test_categories_are_unique_and_reachable(spark):
    v = categories.variant_list()
    assert len(v) == len(set(v)) and all(x == " ".join(x.lower().split()) for x in v)
    df = spark.createDataFrame([("Boil Water Notice - Cork", "old", "Planned"), ("Strange - Cork", "kept", "Planned")], "title string, work_category string, work_type string")
    got = {r.title[:4]: r for r in categories.backfill(df).collect()}
    assert (got["Boil"].work_category, got["Boil"].work_type) == ("boil_notice_issued", "Unplanned")
    assert (got["Stra"].work_category, got["Stra"].work_type) == ("kept", "Planned")


def test_split_large(spark):
    rows = [("T", "core", 60_000), ("T", "clip", 100), (None, "clip", 39_000), (None, "core", 100), ("S", "core", 5)]
    got = {(r.town, r.ward): r.piece for r in areas.split_large(spark.createDataFrame(rows, "town string, ward string, pop long"), "town", "ward", "pop", 50_000, 0.3).collect()}
    assert got[("T", "core")] == "T-core" and got[("T", "clip")] == "T-rest" and got[(None, "core")] is None and got[("S", "core")] == "S"


def test_overlap_audit(spark):
    h = 3_600_000_000
    rows = [("r1", "a", 10, 0, 2 * h), ("r2", "a", 10, h, 3 * h), ("r2", "b", 5, 0, h)]
    r = evaluation.overlap_audit(spark.createDataFrame(rows, "ref string, area string, pop long, s long, e long"), ["ref"], ["area"], "pop").first()
    assert (r.published / h, r.exact / h) == (45, 35)


def test_extraction(spark):
    from spanworks.plans.extract import extract_ends

    said = {
        1: "Works until 2pm on 28 April.", 2: "**Update 10:15am 18/05/2026** Works are now complete.", 3: "Works nightly until 7am on 5 May", 4: "until further notice until 2pm on 5 May",
        5: "<p>Works now have an estimated completion time of midday on 3rd of May 2026</p>", 6: "The notice is lifted until 2pm on 5 May", 7: "críoch leis an obair. until 2pm on 5 May", 8: "until 2pm on 5 May and 6 May",
        9: "until 2pm on 31 April", 10: None, 11: "", 12: "works are complete", 13: "**9in 28/04/2026** works have been completed",
    }
    df = spark.createDataFrame([(k, "2026-04-20", v, "extra") for k, v in said.items()], "id long, start_date string, description string, end_note string")
    got = {r.id: (r.end_source, r.local_date, r.local_time) for r in extract_ends(df).collect()}
    none = (None, None, None)
    assert got[1] == ("scheduled_end_with_time", "2026-04-28", "14:00") and got[2] == ("completion_update", "2026-05-18", "10:15")
    assert got[5] == ("scheduled_end_with_time", "2026-05-03", "12:00") and got[13] == ("completion_update", "2026-04-28", "21:00")
    assert all(got[k] == none for k in (3, 4, 6, 7, 8, 9, 10, 11, 12))


def test_feed(spark):
    from spanworks.sources import readers

    def page(offset, size):
        rows = [{"attributes": {"OBJECTID": i, "TITLE": " A - B " if i % 2 else "", "COUNTY": "Dnegal", "STARTDATE": 0, "DESCRIPTION": "" if i == 4 else "d"}, "geometry": {"x": 0.0, "y": 0.0}} for i in range(5)]
        return [json.dumps(r) for r in rows[offset : offset + size]]

    readers.FeedSource.fetchers["test"] = page
    reader = readers.FeedSource({"fetch": "test", "count": "5", "size": "2"}).reader(None)
    pages = [list(reader.read(p)) for p in reader.partitions()]
    assert [len(p) for p in pages] == [2, 2, 1]
    raw = spark.createDataFrame([r for p in pages for r in p], "feature string")
    cases, rejected = readers.map_cases(readers.features(raw))
    got = {r.id: r for r in cases.collect()}
    assert sorted(got) == [0, 1, 2, 3] and [r.id for r in rejected.collect()] == [4]
    assert (got[0].title, got[1].title, got[0].county, got[0].full_lat) == ("unknown", "A - B", "Donegal", 0.0)
    assert got[0].start_date == dt.datetime(1970, 1, 1)
    with pytest.raises(Exception, match="no features"):
        readers.features(spark.createDataFrame([(json.dumps({"error": 1}),)], "feature string")).collect()


def test_files(spark, tmp_path):
    from spanworks.sources import readers, sinks

    df = spark.createDataFrame([(1, "a\nb"), (2, 'q"')], "id long, t string")
    assert sinks.new_round(df, f"{tmp_path}/r").endswith("/r") and sinks.new_round(df, f"{tmp_path}/r").endswith("/r_r2")
    assert {r.t for r in readers.read_csv(spark, f"{tmp_path}/r", "id long, t string", multiline=True).collect()} == {"a\nb", 'q"'}
    (tmp_path / "w.csv").write_bytes("id,t\n1,caf\xe9 \u20ac\n".encode("cp1252"))
    assert readers.read_csv(spark, f"{tmp_path}/w.csv", "id long, t string", "windows-1252").first().t == "caf\xe9 \u20ac"
    sinks.county_shards(spark.createDataFrame([("Cork", 1)], "county string, n int"), spark.createDataFrame([("Cork",), ("Kerry",)], "county string"), f"{tmp_path}/s")
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["shard=cork", "shard=kerry"]
    assert sinks.payload(spark.createDataFrame([(1, None, "x")], "k int, a string, b string"), ["k"]).first().payload == '{"b":"x"}'
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "2026-05-01.jsonl").write_text('{"id": 1, "status": "Open"}\n\n{"id": 2}\n')
    assert {(r.id, r.tag) for r in readers.read_snapshots(spark, f"{tmp_path}/log").collect()} == {(1, "2026-05-01"), (2, "2026-05-01")}


def test_streamed_upsert(spark, tmp_path):
    from spanworks.streaming.windows import upsert_batches

    spark.createDataFrame([(1, "Open", "a")], CASE).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(CASE).parquet(f"{tmp_path}/in")
    upsert_batches(stream, f"{tmp_path}/out", lambda e: F.lit(f"t{e}")).awaitTermination()
    spark.createDataFrame([(1, "Closed", "b")], CASE).write.mode("append").parquet(f"{tmp_path}/in")
    upsert_batches(stream, f"{tmp_path}/out", lambda e: F.lit(f"t{e}")).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out/version=1").first().closed_at == "t1"


def test_four_decimals_are_those_of_the_exact_value(spark):
    from spanworks.functions.geo import four_decimals

    rng = random.Random(5)
    values = [rng.uniform(-180, 180) for _ in range(2000)] + [s * (w + (2 * n + 1) / 20000) for w in (0, 8, 53, 127) for n in range(0, 10000, 7) for s in (1, -1)]
    values += [0.0, -0.0, 53.03125, 53.09375, -6.03125, 1e-300, 0.00005, 0.99995, 53.99995, 53.99999999]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", four_decimals(F.col("x")).alias("k")).collect()
    assert [r.k for r in got] == [round(round(r.x, 4) * 10_000) for r in got]
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "x double").select(four_decimals(F.col("x")).alias("k")).collect()
    assert [r.k for r in odd] == [None, None, None]


def test_build_logs_side_by_side(spark):
    from spanworks.plans import site

    got = spark.createDataFrame(
        [(True, "imputed_from_start", None, None, "Open"), (False, "accrues", "refused: whole day", None, "Closed"), (False, None, "expanded", "x", None), (None, "token", "none", "x", "Open")],
        "imputed boolean, outcome string, recurrence_tag string, end_source string, status string",
    )
    docs = spark.createDataFrame([("é",), (None,), ("",)], "payload string")
    log = {r.figure: r.value for r in site.log_of(got, docs).collect()}
    assert log == {"notices": 4, "imputed": 1, "accruing": 1, "refused": 1, "expanded": 1, "not_inferred": 2, "not_inferred_open": 1, "payload_documents": 3, "payload_bytes": 2}
    none = {r.figure: r.value for r in site.log_of(got.limit(0), docs.limit(0)).collect()}
    assert set(none) == set(log) and set(none.values()) == {0}
    now, before = spark.createDataFrame([("a", 5), ("b", 1)], "figure string, value bigint"), spark.createDataFrame([("a", 7), ("c", 2)], "figure string, value bigint")
    assert {tuple(r) for r in site.changes(now, before).collect()} == {("a", 7, 5, -2), ("b", None, 1, 1), ("c", 2, None, -2)}


def _reached(spark):
    """Events in groups that share their places with another group or have them alone, and people too many for a long."""
    h = 3_600_000_000
    events = spark.createDataFrame([(1, 0, "a", 0, 2 * h), (1, 0, "b", h, 3 * h), (1, 0, "b", h, 2 * h), (2, 0, "c", 0, 4 * h), (1, 5, "d", 0, h)], "region long, digit long, ref string, s long, e long")
    members = spark.createDataFrame([(1, 0, 10, 7_000_000_000), (1, 0, 20, 5), (2, 0, 20, 5), (2, 0, 30, 11), (2, 0, 30, 12), (3, 0, 40, 1)], "region long, digit long, area long, pop long")
    return events, members, ["region", "digit"], h


def test_event_overlap_of_groups(spark):
    events, members, group, h = _reached(spark)
    each = events.join(members, group).select("region", "ref", "area", "pop").distinct()
    cap = spark.createDataFrame([(2, 20)], "region long, population long")
    got, want = (
        {r.month: (int(r.published), int(r.exact), r.twice_pct) for r in evaluation.event_overlap(events, f, ["region", "ref"], "region", "area", "pop", cap, g).collect()}
        for f, g in ((members, group), (each, None))
    )
    published, exact = (2 * 7_000_000_005 + 2 * 7_000_000_005 + 4 * 20) * h, (3 * 7_000_000_005 + 4 * 28) * h
    assert published > 2**63 and got == want == {m: (published, exact, 25.0) for m in ("1970-01", "TOTAL")}


def test_reached_audit(spark):
    events, members, group, h = _reached(spark)
    each = events.join(members, group)
    plain = evaluation.overlap_audit(each, ["region", "ref"], ["area"], "pop").collect()
    got = evaluation.reached_audit(events, members, ["region", "ref"], group, "area", "pop").collect()
    # the area of two regions counts once, for as long as any of its events lasts
    assert [int(x) for x in got[0][1:]] == [int(x) for x in plain[0][1:]] == [(4 * 7_000_000_005 + 4 * 28) * h, (3 * 7_000_000_000 + 4 * 28) * h]


def test_homed_takes_the_largest_of_a_group(spark):
    pins = spark.createDataFrame([(1, 0, "x"), (2, 1, "x"), (3, 9, "x"), (4, 0, "x"), (4, 1, "y"), (None, 0, "x")], "id long, grp long, ref string")
    members = spark.createDataFrame([(0, 20, 5), (0, 10, 5), (0, 30, 4), (1, 40, 6), (1, 50, 0)], "grp long, area long, pop long")
    got = areas.homed(pins, members, "id", ["grp"], "area", "pop")
    assert {(r.id, r.grp, r.ref): r.area for r in got.collect()} == {(1, 0, "x"): 10, (2, 1, "x"): 40, (3, 9, "x"): None, (4, 0, "x"): 40, (4, 1, "y"): 40, (None, 0, "x"): None}
