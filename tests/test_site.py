"""The resolver's decision, branch by branch, and the published figures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spanworks.plans.resolve import COLUMNS, resolve
from spanworks.plans.site import build

T = dt.datetime
NOW = "2026-05-10 00:00:00"
EXTRA = COLUMNS + ", title string, closed_at timestamp, full_lat double, full_lon double"
DEFAULT = dict(id=1, county="Carlow", reference_num="CAR1", work_category="burst_main", work_type="Unplanned", status="Closed", start=T(2026, 5, 1), location="Somewhere", description="works", span=86400.0, end_source="completion_update", end_date="2026-05-02", end_time="00:00", title="t", full_lat=52.836, full_lon=-6.926)


def cases(spark, *rows):
    names = [c.split()[0] for c in EXTRA.split(", ")]
    return spark.createDataFrame([tuple({"id": k + 1, **r}.get(n, DEFAULT.get(n) if n != "id" else k + 1) for n in names) for k, r in enumerate(rows)], EXTRA)


def outcome(spark, *rows, **kw):
    got = {r.id: r for r in resolve(cases(spark, *rows), F.lit(NOW).cast("timestamp"), **kw).collect()}
    return got


def hours(r):
    return [(i.e - i.s) / 3.6e9 for i in r.intervals]


def test_branches(spark):
    none = dict(span=None, end_source=None, end_date=None, end_time=None)
    boil = dict(work_category="boil_notice_issued", location="X scheme", **none)
    got = outcome(
        spark, {}, {**none, "status": "Open"}, {**none}, {**none, "end_source": "lifted_immediate", "status": "Open"}, {**boil, "status": "Open"}, {**boil, "location": "Y"},
        {**boil, "status": "Open", "start": T(2026, 4, 1), "location": "Z"}, {**boil, "location": "Q", "start": T(2026, 4, 1)}, dict(work_category="boil_notice_lifted", location="Q Water Supply", start=T(2026, 5, 1)), {"span": 40 * 86400.0},
        {"span": None, "end_source": "completion_update", "end_date": "2026-04-30", "end_time": "12:00"},
    )
    assert got[1].outcome == "span" and hours(got[1]) == [24.0] and got[1].observed_end
    assert got[2].outcome == "accrues" and hours(got[2]) == [216.0] and not got[2].has_end
    assert got[3].outcome == "imputed_from_start" and got[3].imputed and got[4].outcome == "imputed_from_start"
    assert got[5].outcome == "accrues" and got[6].outcome == "token" and 7 not in got and 9 not in got
    assert got[8].outcome == "paired" and hours(got[8]) == [336.0] and (got[8].in_force[0].e - got[8].in_force[0].s) / 3.6e9 == 720.0
    assert hours(got[10]) == [336.0]
    assert got[11].outcome == "imputed_to_end" and got[11].intervals[0].e == int(T(2026, 4, 30, 11, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert outcome(spark, {**none}, impute=False)[1].outcome == "token"
    assert outcome(spark, {}, counties=spark.createDataFrame([("Cork",)], "county string")) == {}


def test_recurrence(spark):
    night = dict(recurrence="daily", window_open="22:00", window_close="07:00", window_first="2026-05-01", span=5 * 86400.0 + 6 * 3600, end_source="scheduled_end_with_time", end_time="07:00", reference_num="N")
    got = outcome(spark, night, {**night, "end_time": "08:00", "reference_num": "A"}, {**night, "window_open": "07:00", "reference_num": "B"}, {**night, "window_first": "soon", "reference_num": "C"}, {**night, "recurrence": None, "window_open": None, "end_source": "completion_update"}, {**night, "span": 3600.0, "reference_num": "D"})
    assert got[1].recurrence_tag == "expanded" and len(got[1].intervals) == 5 and got[1].sev == "degraded"
    assert [got[k].recurrence_tag.split(":")[0] for k in (2, 3, 4, 6)] == ["refused"] * 4 and len(got[2].intervals) == 1
    assert got[5].recurrence_tag == "expanded_inherited"


@pytest.fixture(scope="module")
def site(spark):
    small = spark.createDataFrame([("SA1", 52.836, -6.926, 1000), ("SA2", 53.9, -9.0, 77)], "guid string, lat double, lon double, pop long")
    area = spark.createDataFrame([("SA1", "T1", "Testtown", "Carlow"), ("SA2", "T2", "Other", "Mayo")], "guid string, code string, name string, county string")
    counties = spark.createDataFrame([("Carlow", 61968), ("Mayo", 137970)], "county string, population long")
    rows = cases(spark, {}, dict(county="Mayo", reference_num="M", start=T(2026, 5, 3)))
    return {k: v.collect() for k, v in build(rows, small, area, counties, F.lit(NOW).cast("timestamp"), F.lit("2026-04-20 00:00:00").cast("timestamp")).items()}


def test_county_month(site):
    r = next(x for x in site["months"] if x.county == "Carlow")
    assert (r.person_us / 3.6e9, r.availability, r.grade, r.n_outage) == (24_000, 99.821, "B", 1)


def test_area_month(site):
    by = {(x.county, x.code): x for x in site["area_months"]}
    assert round(by["Carlow", "T1"].availability, 2) == 88.89
    assert by["Mayo", "unplaced"].availability is None and by["Mayo", "unplaced"].events == 1


def test_rankings_and_medians(site):
    assert [(x.county, x.person_h) for x in site["top"]][0] == ("Carlow", 24000)
    assert site["national"][0].median_observed == 24.0 and site["national"][0].observed_n == 2
    assert {x.recurrence_tag for x in site["recurrence"]} == {"none"} and len(site["days"]) == 2


def test_quiet_months_and_days(site):
    months = {(r.county, str(r.month)): r for r in site["county_months"]}
    assert len(months) == 4 and (months["Carlow", "2026-05-01"].n_outage, months["Carlow", "2026-05-01"].person_h, months["Carlow", "2026-05-01"].period_h) == (1, 24_000, 216)
    quiet = months["Carlow", "2026-04-01"]
    assert (quiet.n_outage, quiet.availability, quiet.grade, quiet.health_n, quiet.health_now) == (0, 100.0, "A", 0, 0)
    days = {(r.county, str(r.day)): r for r in site["county_days"]}
    assert len(days) == 2 * 61 and days["Carlow", "2026-04-19"].sev == "nd" and not days["Carlow", "2026-04-19"].elapsed
    assert days["Carlow", "2026-05-01"].sev == "outage" and days["Carlow", "2026-05-02"].clear and not days["Carlow", "2026-05-11"].elapsed


def test_histories_follow_the_pins(site):
    found = {(r.county, r.code, r.ref): r for r in site["history"]}
    assert set(found) == {("Carlow", "T1", "CAR1"), ("Mayo", "unplaced", "M")}
    r = found["Carlow", "T1", "CAR1"]
    assert (r.name, r.hours, r.people, r.areas, r.place, r.confirmed) == ("Testtown", 24.0, 1000, None, 1, 1)


def test_build_figures(spark):
    from spanworks.plans.site import observed

    rows, watch = observed(resolve(cases(spark, {}, dict(span=None, end_source=None, end_date=None, end_time=None)), F.lit(NOW).cast("timestamp")), "figures")
    assert rows.count() == 2 and watch.get["cases"] == 2 and watch.get["imputed"] == 1


def test_snapshot_names(spark, tmp_path):
    from spanworks.sources.readers import read_snapshots

    (tmp_path / "2000-01-01").mkdir()
    (tmp_path / "2000-01-01" / "2026-05-01.jsonl").write_text('{"id": 1, "status": "Open"}\n')
    assert read_snapshots(spark, f"{tmp_path}/2000-01-01").first().tag == "2026-05-01"
    (tmp_path / "2000-01-01" / "other.jsonl").write_text('{"id": 1, "status": "Open"}\n')
    with pytest.raises(Exception, match="no date names the snapshot"):
        read_snapshots(spark, f"{tmp_path}/2000-01-01").collect()


def test_last_row_of_a_batch_counts(spark):
    from spanworks.operators.state import upsert

    none = spark.createDataFrame([], "id long, status string, start_date string, first_seen string, last_seen string, closed_at string, first_start_date string")
    rows = spark.createDataFrame([(1, "Zz", "2026-01-01"), (1, "Aa", "2026-01-02")], "id long, status string, start_date string").coalesce(1)
    assert upsert(none, rows, F.lit("now")).first().status == "Aa"


def test_feed_errors():
    from spanworks.sources.readers import FeedError, FeedSource

    calls = []

    def fetch(offset, size):
        calls.append((offset, size))
        if len(calls) < 3:
            raise FeedError(503)
        return {"features": ["{}"] * max(0, min(size, 23 - offset)), "exceededTransferLimit": offset + size < 23}

    FeedSource.fetchers |= {"walk": fetch, "error": lambda o, n: {"error": "gone"}, "denied": lambda o, n: (_ for _ in ()).throw(FeedError(403)), "empty": lambda o, n: {"features": [], "exceededTransferLimit": True}}
    read = lambda **o: [r for p in FeedSource(o).reader(None).partitions() for r in FeedSource(o).reader(None).read(p)]
    assert len(read(fetch="walk", size="2")) == 23
    # pages 1, 3, 7 and 15 are looked at by a row each, then those between; the first was asked for anew after two failures
    assert calls[:9] == [(2, 1), (2, 1), (2, 1), (6, 1), (14, 1), (30, 1), (22, 1), (0, 2), (2, 2)] and calls[9:] == [(o, 2) for o in range(4, 24, 2)]
    assert read(fetch="empty") == []
    with pytest.raises(ValueError, match="gone"):
        read(fetch="error")
    with pytest.raises(FeedError):
        read(fetch="denied")
    with pytest.raises(ValueError, match="more than one page"):
        read(fetch="walk", size="2", one_page="true")
