"""The published figures: county months, days, areas, rankings and totals from resolved cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from spanworks.functions.times import micros
from spanworks.operators import areas as A
from spanworks.operators import intervals, rollup, spatial, typical
from spanworks.operators.severity import marks_health
from spanworks.plans.resolve import exploded, resolve

UNPLACED = "unplaced"


def observed(cases: DataFrame, name: str = "build") -> tuple[DataFrame, Observation]:
    """The resolved cases, and figures of the build that are there once they have been read: cases, imputed, refused windows, open."""
    watch = Observation(name)
    tag = F.coalesce("recurrence_tag", F.lit(""))
    figures = [F.count("*").alias("cases"), F.count_if("imputed").alias("imputed"), F.count_if(tag.startswith("refused")).alias("refused"), F.count_if(tag.startswith("expanded")).alias("expanded"), F.count_if(F.col("outcome") == "accrues").alias("accruing")]
    return cases.observe(watch, *figures), watch


def log_of(got: DataFrame, payload: DataFrame) -> DataFrame:
    """Figures of a build for its log, as rows (``figure``, ``value``): resolved cases by what became of them, cases that nobody has
    inferred an end for, and the payload's documents and bytes."""
    alone, tag = F.col("end_source").isNull(), F.col("recurrence_tag")
    counted = {
        "notices": F.lit(True), "imputed": F.col("imputed"), "accruing": F.col("outcome") == "accrues", "refused": tag.startswith("refused"), "expanded": tag.startswith("expanded"),
        "not_inferred": alone, "not_inferred_open": alone & F.col("status").eqNullSafe("Open"),
    }
    cases = got.agg(*[F.count_if(c).alias(n) for n, c in counted.items()]).unpivot([], list(counted), "figure", "value")
    size = payload.agg(F.count("*").alias("payload_documents"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("payload_bytes"))
    return cases.union(size.unpivot([], ["payload_documents", "payload_bytes"], "figure", "value"))


def changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Two builds' logs side by side: ``before``, ``now`` and ``change`` of each figure; one that a log lacks is null there and counts as nothing."""
    both = before.select("figure", F.col("value").alias("before")).join(now.select("figure", F.col("value").alias("now")), "figure", "full_outer")
    return both.withColumn("change", F.coalesce("now", F.lit(0)) - F.coalesce("before", F.lit(0)))


def build(cases: DataFrame, small_areas: DataFrame, area_of: DataFrame, counties: DataFrame, now: Column, since: Column) -> dict[str, DataFrame]:
    """Tables of the site.

    ``cases`` as :func:`resolve` takes them, with title, closed_at, full_lat, full_lon; ``small_areas``
    has guid, lat, lon, pop; ``area_of`` guid, code, name, county; ``counties`` county, population.
    """
    us_now, us_since = (cases.sparkSession.range(1).select(micros(c)).first()[0] for c in (now, since))
    got = resolve(cases, now, counties)
    pins = got.select(F.col("id").alias("pin"), F.col("full_lat").alias("lat"), F.col("full_lon").alias("lon"))
    reach = spatial.footprints(pins, small_areas.select(F.col("guid").alias("area"), "lat", "lon")).select("pin", F.col("area").alias("guid"))
    spread = got.join(reach, F.col("id") == F.col("pin")).join(small_areas.select("guid", "pop"), "guid").select("id", "county", "sev", "ref", "guid", "pop")
    keys = ["county", "sev", "ref"]
    people = rollup.event_people(spread, keys, "guid", "pop").join(counties, "county").withColumn("people", F.least("people", "population")).select(*keys, "people")
    events = rollup.event_intervals(exploded(got).select(*keys, "s", "e"), keys)
    population = counties.select("county", "population")
    months = rollup.month_table(events, people, "county", population, us_since, us_now, keys)
    days = rollup.day_status(events, people, "county", population, keys)
    per_month = intervals.month_slices(events.where("sev = 'outage'")).groupBy(*keys, "month").agg(F.sum("us").alias("us")).join(people, keys).where("people > 0")
    top = rollup.top_events(per_month.withColumn("person_h", F.bround(F.col("us") * F.col("people") / 3.6e9).cast("bigint")), 10, F.col("person_h"), ["county", "ref"])
    health = intervals.union_intervals(exploded(got.where(marks_health(F.col("work_category"))), "in_force").select("county", "ref", "s", "e"), ["county", "ref"])
    standing = health.groupBy("county").agg(F.countDistinct(F.when(intervals.in_force(F.col("s"), F.col("e"), F.lit(us_now)), F.col("ref"))).alias("health_now"))

    homes = spread.join(area_of.select("guid", "code", F.col("county").alias("_ac")), "guid").where(F.col("county") == F.col("_ac"))
    home = A.dominant(homes, "id", "code", "pop").select("id", "code")
    placed = got.join(home, "id", "left").withColumn("code", F.coalesce("code", F.lit(UNPLACED)))
    akeys = ["county", "code", "sev", "ref"]
    area_events = rollup.event_intervals(exploded(placed).select(*akeys, "s", "e"), akeys)
    inside = A.within(homes, home, "id", "code")
    area_people = rollup.event_people(inside.select("county", "code", "sev", "ref", "guid", "pop"), akeys, "guid", "pop")
    area_pop = area_of.join(small_areas.select("guid", "pop"), "guid").groupBy("county", "code").agg(F.sum("pop").alias("population"))
    cut = area_events.where((F.col("s") < us_now) & (F.col("e") > us_since)).withColumns({"s": F.greatest("s", F.lit(us_since)), "e": F.least("e", F.lit(us_now))})
    per_area = intervals.month_slices(cut).groupBy(*akeys, "month").agg(F.sum("us").alias("us")).join(area_people, akeys, "left")
    lost = F.sum(F.when(F.col("sev") == "outage", F.col("us") * F.coalesce("people", F.lit(0))).otherwise(0))
    area_months = per_area.groupBy("county", "code", "month").agg(F.countDistinct("ref").alias("events"), lost.alias("person_us")).join(area_pop, ["county", "code"], "left")

    # the unplaced have counts only: without a population there is no availability
    area_months = rollup.graded(area_months, us_since, us_now)
    area_months = area_months.withColumns({c: F.when(F.col("code") != UNPLACED, F.col(c)) for c in ("person_us", "availability", "grade")})
    ended = exploded(got).where("sev = 'outage'").groupBy("county", "ref").agg(((F.max("e") - F.min("s")) / 3.6e9).alias("hours"), F.bool_or("observed_end").alias("o"), F.bool_or("has_end").alias("h"), F.bool_or("imputed").alias("i"))
    tiers = ended.withColumn("tier", F.when(F.col("o"), "observed").when(F.col("h"), "scheduled").when(F.col("i"), "imputed"))
    event = ["county", "ref"]
    whole = rollup.event_people(spread.select(*event, "guid", "pop"), event, "guid", "pop").join(counties, "county").withColumn("people", F.least("people", "population"))
    shown = got.withColumn("health", marks_health(F.col("work_category")))
    records = rollup.event_records(shown, exploded(got).select(*event, "s", "e"), whole, event)
    labels = A.first_labels(area_of, ["county", "code"], "guid", ["name"])
    history = A.histories(records, placed.select(*event, "code"), event, "code").join(labels, ["county", "code"], "left")
    in_force = exploded(got.where(marks_health(F.col("work_category"))), "in_force").select("county", "ref", "s", "e")
    return {
        "county_months": rollup.county_months(months, in_force, "county", population, us_since, us_now), "county_days": rollup.county_days(days, "county", population, us_since, us_now),
        "months": months, "days": days, "top": top, "standing": standing, "area_months": area_months, "history": history,
        "medians": typical.tier_medians(tiers, ["county"]), "national": typical.tier_medians(tiers, []),
        "recurrence": got.groupBy("recurrence_tag").agg(F.count("*").alias("notices")),
    }
