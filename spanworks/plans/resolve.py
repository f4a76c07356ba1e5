"""From notices to the intervals that they charge.

A decision per notice, expressed as columns over three lookups that are prepared first:
the lift that ends a standing notice, the typical span of its category, and the window
that its event repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.functions.text import describes_recurrence, event_key, scheme_key
from spanworks.functions.times import micros, reported_end
from spanworks.operators import intervals, pairing, rollup, severity, typical

CAP_US = pairing.CAP_US
OBSERVED = "completion_update"
DAILY = "daily"
COLUMNS = "id bigint, county string, reference_num string, work_category string, work_type string, status string, start timestamp, location string, description string, water_restrictions int, reduced_pressure int, span double, end_source string, end_date string, end_time string, recurrence string, window_open string, window_close string, window_first string"


def load_cases(cases: DataFrame, inferred: DataFrame) -> DataFrame:
    """Cases of a county that have a start, with what was inferred of their ends (at most a row each; null where nothing was)."""
    ends = inferred.select(
        F.col("case_id").alias("id"), F.col("notice_to_end_seconds").alias("span"), "end_source", F.col("end_local_date").alias("end_date"), F.col("end_local_time").alias("end_time"),
        F.col("end_recurrence").alias("recurrence"), F.col("end_window_open").alias("window_open"), F.col("end_window_close").alias("window_close"), F.col("end_window_first_date").alias("window_first"),
    )
    return cases.where("county is not null and start_date is not null").join(ends, "id", "left")


def event_windows(cases: DataFrame) -> DataFrame:
    """(county, ref, w_open, w_close, w_first): the commonest window that an event's pins claim."""
    claims = cases.where(F.col("recurrence") == DAILY).select("county", "ref", F.col("window_open").alias("w_open"), F.col("window_close").alias("w_close"), F.col("window_first").alias("w_first"))
    return rollup.modal(claims, ["county", "ref"], ["w_open", "w_close", "w_first"])


def resolve(cases: DataFrame, now: Column, counties: DataFrame | None = None, impute: bool = True) -> DataFrame:
    """Cases that are events, with ``sev``, ``outcome``, ``intervals`` and ``in_force`` (arrays of s, e in
    microseconds), ``has_end``, ``observed_end``, ``imputed`` and ``recurrence_tag``.

    Lifts, notices of unknown counties and standing notices that are open beyond the cap
    without a lift are left out.
    """
    at = micros(F.col("start"))
    c = cases.withColumns({"ref": event_key(F.col("reference_num"), F.col("id")), "at": at, "scheme": scheme_key(F.col("location"))})
    if counties is not None:
        c = c.join(counties.select("county").distinct(), "county", "left_semi")
    lifts = c.where(F.col("work_category").isin([*severity.LIFT_OF.values()])).select("county", "scheme", F.col("work_category").alias("ends"), "at")
    issues = c.withColumn("ends", severity.lift_category(F.col("work_category")))
    paired = pairing.first_after(issues.where("ends is not null"), lifts, ["county", "ends", "scheme"])
    observed = c.where((F.col("end_source") == OBSERVED) & F.col("span").isNotNull())
    spans = typical.typical_spans(observed.select(F.col("work_category").alias("_cat"), "span"), "_cat", "span", cap=CAP_US / 1e6)
    overall = typical.spread_median(observed.select(F.least("span", F.lit(CAP_US / 1e6)).alias("x")), [], "x").select(F.col("median").alias("_overall"), F.lit(1).alias("_one"))
    windows = event_windows(c).withColumnsRenamed({"county": "_wc", "ref": "_wr"})
    speaks = c.where(describes_recurrence(F.col("description"))).select("county", "ref").union(c.where(F.col("recurrence") == DAILY).select("county", "ref")).distinct().select(F.col("county").alias("_rc"), F.col("ref").alias("_rr"), F.lit(True).alias("repeats"))

    x = c.join(paired, "id", "left").join(spans.select("_cat", "typical"), F.col("work_category").eqNullSafe(F.col("_cat")), "left").withColumn("_one", F.lit(1)).join(F.broadcast(overall), "_one", "left")
    x = x.join(windows, (F.col("county") == F.col("_wc")) & (F.col("ref") == F.col("_wr")), "left").join(speaks, (F.col("county") == F.col("_rc")) & (F.col("ref") == F.col("_rr")), "left")
    x = x.withColumn("sev", severity.severity(F.col("work_category"), F.col("work_type"), F.col("water_restrictions"), F.col("reduced_pressure"), F.coalesce("repeats", F.lit(False)))).where("sev is not null")

    us_now = micros(now)
    is_open = F.col("status").eqNullSafe("Open")
    boil = F.coalesce(F.col("work_category") == "boil_notice_issued", F.lit(False))
    source = F.coalesce("end_source", F.lit("not_found"))
    over = (source == "lifted_immediate") | ((source != "not_found") & F.col("end_date").isNotNull())
    lifted = F.col("lift_at").isNotNull()
    charge = F.least((F.coalesce("typical", F.col("_overall")) * 1e6).cast("bigint"), F.lit(CAP_US)) if impute else F.lit(None).cast("bigint")
    known = micros(reported_end(F.col("end_date"), F.col("end_time")))
    outcome = (
        F.when(boil & lifted, "paired").when(boil & ~is_open, "token").when(boil & (us_now - F.col("at") > CAP_US), "dropped").when(boil, "accrues")
        .when(F.col("span").isNotNull(), "span")
        .when(~over & lifted, "paired").when(~over & is_open & (F.col("at") < us_now), "accrues")
        .when(F.coalesce(charge, F.lit(0)) == 0, "token").when(known.isNotNull(), "imputed_to_end").otherwise("imputed_from_start")
    )
    x = x.withColumn("outcome", outcome).where("outcome <> 'dropped'")
    o, s0 = F.col("outcome"), F.col("at")
    end = (
        F.when(o == "paired", pairing.charged_end(pairing.paired_end(F.col("lift_at"), s0), s0))
        .when(o == "accrues", F.greatest(s0, F.least(us_now, s0 + CAP_US)))
        .when(o == "span", s0 + F.least((F.col("span") * 1e6).cast("bigint"), F.lit(CAP_US)))
        .when(o == "imputed_to_end", known).when(o == "imputed_from_start", s0 + charge).otherwise(s0 + 1_000_000)
    )
    x = x.withColumns({"_s": F.when(o == "imputed_to_end", known - charge).otherwise(s0), "_e": end})

    claimed = F.coalesce(F.col("recurrence") == DAILY, F.lit(False))
    w = {k: F.when(claimed, F.col(f"window_{k}")).otherwise(F.col(f"w_{k}")) for k in ("open", "close", "first")}
    asks = (o == "span") & (claimed | F.col("_wc").isNotNull())
    clock = r"^([01]\d|2[0-3]):[0-5]\d$"
    readable = F.coalesce(w["open"].rlike(clock) & w["close"].rlike(clock) & F.try_to_date(w["first"]).isNotNull(), F.lit(False))
    by_report = F.col("end_source").eqNullSafe(OBSERVED) | w["close"].eqNullSafe(F.substring("end_time", 1, 5))
    nights = F.when(asks & readable, intervals.civil_windows(F.try_to_date(w["first"]), w["open"], w["close"], F.timestamp_micros("_s"), F.timestamp_micros("_e")))
    x = x.withColumn("_nights", nights)
    tag = (
        F.when(~asks, "none").when(~readable, "refused: unreadable window").when(w["open"] == w["close"], "refused: whole day").when(~by_report, "refused: close is not the reported end")
        .when(F.size("_nights") < 2, "refused: single window").when(~claimed, "expanded_inherited").when(F.col("end_source").eqNullSafe(OBSERVED), "expanded_observed").otherwise("expanded")
    )
    x = x.withColumn("recurrence_tag", tag)
    whole = F.array(F.struct(F.col("_s").alias("s"), F.col("_e").alias("e")))
    x = x.withColumn("intervals", F.when(F.col("recurrence_tag").startswith("expanded"), F.col("_nights")).otherwise(whole))
    stands = F.when(o == "paired", F.array(F.struct(s0.alias("s"), pairing.paired_end(F.col("lift_at"), s0).alias("e")))).otherwise(F.col("intervals"))
    return x.select(
        *cases.columns, "ref", "sev", "outcome", "intervals", stands.alias("in_force"), o.isin("paired", "span").alias("has_end"),
        ((o == "paired") | ((o == "span") & F.col("end_source").eqNullSafe(OBSERVED))).alias("observed_end"), o.startswith("imputed").alias("imputed"), "recurrence_tag",
    )


def exploded(resolved: DataFrame, which: str = "intervals") -> DataFrame:
    """One row per interval: ``s`` and ``e``."""
    return resolved.withColumn("_i", F.explode(which)).withColumns({"s": F.col("_i.s"), "e": F.col("_i.e")}).drop("_i")


def demo_cases(spark, d: str) -> DataFrame:
    """Events dressed as cases, so that each branch of the decision has some."""
    from spanworks.plans.bindings import table

    e = table(spark, d, "events")
    cats = ["burst_main", "mains_repair", "boil_notice_issued", "boil_notice_lifted", "consumption_notice_issued", "consumption_notice_lifted", "low_pressure", "other"]
    k, null = F.col("event_id"), lambda t: F.lit(None).cast(t)
    source = F.when(k % 6 == 0, "completion_update").when(k % 6 == 1, "scheduled_end_with_time").when(k % 6 == 2, "not_found").when(k % 6 == 3, "lifted_immediate")
    start = F.col("ts").cast("timestamp")
    day = F.when((k % 6).isin(0, 1), F.date_format(start, "yyyy-MM-dd"))
    return e.select(
        k.alias("id"), F.concat(F.lit("c"), (F.col("user_id") % 25).cast("string")).alias("county"), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("R"), F.col("user_id").cast("string"))).alias("reference_num"),
        F.get(F.array(*map(F.lit, cats)), (k % 8).cast("int")).alias("work_category"), F.when(k % 5 == 0, "Planned").otherwise("Unplanned").alias("work_type"), F.when(k % 4 == 0, "Open").when(k % 4 == 1, "Closed").alias("status"),
        start.alias("start"), F.concat(F.lit("Place "), (F.col("user_id") % 10).cast("string"), F.lit(" Public Supply")).alias("location"), F.lit("works").alias("description"),
        F.when(k % 31 == 0, 1).alias("water_restrictions"), null("int").alias("reduced_pressure"), F.when((k % 6).isin(0, 1) & (k % 7 != 0), F.round(F.col("value") * 60)).alias("span"), source.alias("end_source"),
        day.alias("end_date"), F.when(day.isNotNull() & (k % 2 == 0), "18:00").alias("end_time"), null("string").alias("recurrence"), null("string").alias("window_open"), null("string").alias("window_close"), null("string").alias("window_first"),
    )
