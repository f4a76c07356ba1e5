"""Extraction with an injected model, enrichment, and small reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spanworks.operators import areas, evaluation
from spanworks.plans.hybrid import enrich, extract_all
from spanworks.sources import sinks


def test_rules_first_then_the_model_once_per_text(spark):
    rows = [(1, "2026-04-20", "until 2pm on 28 April"), (2, "2026-04-20", "until further notice"), (3, "2026-04-20", "until further notice"), (4, "2026-04-20", "broken"), (5, "2026-04-20", None)]

    def model(start, text):
        if text == "broken":
            raise ValueError("no reply")
        return {"end_source": "not_found"}

    df = spark.createDataFrame(rows, "id long, start_date string, description string")
    got = {r.id: r for r in extract_all(df, model).collect()}
    assert got[1].model == "rules" and got[1].local_date == "2026-04-28"
    assert got[2].end_source == got[3].end_source == "not_found" and got[4].error == "ValueError: no reply" and 5 not in got
    assert {r.id for r in extract_all(df).collect()} == {1}


def test_enrichment(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 4.0)], "rounded_lat double, rounded_lon double")

    def lookup(lat, lon):
        if lat == 3.0:
            raise OSError("down")
        return '{"address": {"county": "County Cork"}}'

    got = enrich(df, ["rounded_lat", "rounded_lon"], lookup)
    flat = sinks.geocode_rows(got, ["county"]).withColumn("county", F.col("county"))
    by = {r.rounded_lat: r for r in flat.collect()}
    assert by[1.0].county == "County Cork" and by[3.0].county is None and by[3.0].failed
    assert [r.rounded_lat for r in sinks.to_geocode(df, got).collect()] == [3.0]
    cases = df.withColumn("county", F.lit(""))
    assert {r.county for r in sinks.backfill_county(cases.where("rounded_lat = 1"), flat).collect()} == {"Cork"}
    with pytest.raises(Exception, match="in a row"):
        enrich(spark.range(40).select(F.lit(3.0).alias("rounded_lat"), F.col("id").cast("double").alias("rounded_lon")).coalesce(1), ["rounded_lat", "rounded_lon"], lookup).collect()


def test_reports(spark):
    h = 3_600_000_000
    at = int(dt.datetime(2026, 7, 9, 21, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    nights = [(at + k * 24 * h, at + k * 24 * h + 9 * h) for k in range(3)]
    df = spark.createDataFrame([("e", "expanded", at, nights), ("e", "none", at, [(at, at + h)]), ("f", "none", at, [(at, at + h)])], "ref string, recurrence_tag string, start_us long, intervals array<struct<s:bigint,e:bigint>>")
    assert df.where("size(intervals) > 1").select(evaluation.window_label(F.col("intervals"))).first()[0] == "22:00-07:00 from 2026-07-09"
    r = {x.recurrence_tag: x for x in evaluation.recurrence_counts(df).collect()}
    assert (r["expanded"].hours, r["expanded"].unbroken_hours) == (27.0, 57.0)
    assert [tuple(x) for x in evaluation.mixed_events(df, ["ref"]).collect()] == [("e", 2, 1)]


def test_census_total(spark):
    c, p = spark.createDataFrame([("a",), ("b",)], "guid string"), spark.createDataFrame([("a", 2), ("b", 3)], "guid string, pop long")
    assert areas.with_people(c, p, total=5).count() == 2
    with pytest.raises(Exception, match="add up"):
        areas.with_people(c, p, total=6).collect()
