"""Accuracy, agreement and overlap tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanworks.operators.intervals import DAY_US, month_slices, person_us, union_intervals


def accuracy(df: DataFrame, by: str, verdict: str) -> DataFrame:
    """Counts of correct, incorrect and abstained rows per class and in total; accuracy over judged rows."""
    one = lambda v: F.count_if(F.col(verdict) == v)
    out = df.rollup(by).agg(F.count("*").alias("n"), one("correct").alias("correct"), one("incorrect").alias("incorrect"), one("abstain").alias("abstained"), F.grouping(by).alias("_g"))
    judged = F.col("correct") + F.col("incorrect")
    return out.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col(by)).alias(by), "n", "correct", "incorrect", "abstained", F.bround(F.try_divide(100.0 * F.col("correct"), judged), 2).alias("accuracy"))


def agreement(df: DataFrame, by: str, kind: str, kinds: list[str]) -> DataFrame:
    """A column of counts for each kind of agreement."""
    return df.groupBy(by).pivot(kind, kinds).count().fillna(0, kinds)


def overlap_audit(intervals: DataFrame, groups: list[str], place: list[str], people: str) -> DataFrame:
    """Per month: person-microseconds (decimals) summed over groups, and with each place counted once.

    ``intervals``: groups, place, s, e (microseconds), people of the place.
    """
    def by(keys: list[str], name: str) -> DataFrame:
        merged = union_intervals(intervals.select(*keys, people, "s", "e"), [*keys, people])
        return month_slices(merged).groupBy("month").agg(F.sum(person_us(F.col("us"), F.col(people))).alias(name))

    return by([*groups, *place], "published").join(by(place, "exact"), "month", "full_outer")


def reached_audit(events: DataFrame, members: DataFrame, event: list[str], group: list[str], place: str, people: str) -> DataFrame:
    """:func:`overlap_audit` of events that lie in one group each and reach all of its places, without a row for each event and place.

    ``events``: event, group, s, e (microseconds); ``members``: group, place, people, where a place may be in several groups.
    """
    key = list(dict.fromkeys([*event, *group]))
    merged = union_intervals(events.select(*key, "s", "e"), key)
    places = members.select(*group, place, people).distinct()
    sums = places.groupBy(*group).agg(F.sum(people).alias("_people"))
    published = month_slices(merged.join(sums, group)).groupBy("month").agg(F.sum(person_us(F.col("us"), F.col("_people"))).alias("published"))
    return published.join(_once(merged, _alike(places, group, place, people, []), group), "month", "full_outer")


def _alike(members: DataFrame, group: list[str], place: str, people: str, apart: list[str]) -> DataFrame:
    """Places of the same groups as one: a row for each of these groups, with ``_where``, all of them, and the people together.

    ``apart`` are columns of the group that tell places of one name apart."""
    alike = members.groupBy(*apart, place, people).agg(F.array_sort(F.collect_set(F.struct(*group))).alias("_where"))
    return alike.groupBy("_where").agg(F.sum(people).alias("_people")).select("_where", "_people", F.explode("_where").alias("_g")).select("_where", "_people", "_g.*")


def _once(merged: DataFrame, alike: DataFrame, group: list[str]) -> DataFrame:
    """Per month ``exact``: person-microseconds with each place counted once."""
    spread = union_intervals(merged.join(alike, group).select("_where", "_people", "s", "e"), ["_where", "_people"], presplit_us=DAY_US)
    return month_slices(spread).groupBy("month").agg(F.sum(person_us(F.col("us"), F.col("_people"))).alias("exact"))


def event_overlap(events: DataFrame, footprint: DataFrame, event: list[str], region: str, place: str, people: str, cap: DataFrame | None = None, group: list[str] | None = None) -> DataFrame:
    """Per month and in TOTAL: person-microseconds (decimals) summed over events, and with each place counted once, and what
    part of the first is counted twice.

    ``events``: event, s, e; ``footprint``: event, place, people.  An event's people are those of its distinct places, at most
    the region's in ``cap`` (region, population); all of its intervals hold for all of its places.  With ``group`` (region and more)
    ``footprint`` is group, place, people, and each event is in one group, whose columns it brings and all of whose places are its
    own: then there is no row for each event and place.
    """
    at = group or event
    key = list(dict.fromkeys([*event, *at]))
    merged = union_intervals(events.select(*key, "s", "e"), key)
    places = footprint.select(*at, place, people).distinct()
    who = places.groupBy(*at).agg(F.sum(people).alias("_people"))
    if cap is not None:
        who = who.join(cap.select(region, "population"), region, "left").withColumn("_people", F.least("_people", F.coalesce("population", "_people")))
    published = month_slices(merged.join(who.select(*at, "_people"), at)).groupBy("month").agg(F.sum(person_us(F.col("us"), F.col("_people"))).alias("published"))
    if group:
        exact = _once(merged, _alike(places, group, place, people, [region]), group)
    else:
        spread = union_intervals(merged.join(places, event).select(region, place, people, "s", "e"), [region, place, people])
        exact = month_slices(spread).groupBy("month").agg(F.sum(person_us(F.col("us"), F.col(people))).alias("exact"))
    none = F.lit(0).cast("decimal(38,0)")
    both = published.join(exact, "month", "full_outer").select(F.date_format("month", "yyyy-MM").alias("month"), F.coalesce("published", none).alias("published"), F.coalesce("exact", none).alias("exact"))
    out = both.rollup("month").agg(F.sum("published").alias("published"), F.sum("exact").alias("exact"))
    twice = 100.0 * (F.col("published") - F.col("exact")).cast("double")
    return out.select(F.coalesce("month", F.lit("TOTAL")).alias("month"), "published", "exact", F.bround(F.try_divide(twice, F.col("published").cast("double")), 3).alias("twice_pct"))


def replay(labelled: DataFrame, answers: DataFrame, key: str = "id") -> DataFrame:
    """Judge an extractor's answers by a labelled round: key, true_source, verdict (correct, incorrect, abstain).

    ``labelled`` as :func:`truth` takes it; rows without a verdict or with ``unsure`` are left out.  ``answers``: key,
    source, date, time, failed; a failed call is a miss, and a missing answer or one without a source abstains.
    """
    from spanworks.functions.text import first_said, minute_time

    verdict = F.lower(F.trim(F.coalesce("human_verdict", F.lit(""))))
    rows = truth(labelled.where(~verdict.isin("", "unsure"))).join(answers.select(key, *[F.col(c).alias(f"_{c}") for c in ("source", "date", "time", "failed")]), key, "left")
    same = (F.col("true_source") == first_said(F.col("_source"))) & (F.col("true_date") == first_said(F.col("_date"))) & (F.col("true_time") == minute_time(F.col("_time")))
    judged = F.when(F.coalesce("_failed", F.lit(False)), "incorrect").when(first_said(F.col("_source")) == "", "abstain").when(same, "correct").otherwise("incorrect")
    return rows.select(key, "true_source", judged.alias("verdict"))


def described(cases: DataFrame, keys: list[str]) -> DataFrame:
    """Per event what a reviewer reads: the least case id, and the longest description (of equals the first by id)."""
    longest = F.max_by("description", F.struct(F.length(F.coalesce("description", F.lit(""))), -F.col("id")))
    return cases.groupBy(*keys).agg(F.min("id").alias("case_id"), longest.alias("description"))


def lint_windows(cases: DataFrame, inferred: DataFrame) -> DataFrame:
    """:func:`unquotable_windows` of the cases that have an inference: id, text and start from the one table, the window from the other."""
    ends = inferred.select(F.col("case_id").alias("id"), "recurrence", "window_open", "window_close", "window_first")
    return unquotable_windows(cases.select("id", "description", "start_date").join(ends, "id"))


def unquotable_windows(cases: DataFrame) -> DataFrame:
    """Recurring windows with values that their text doesn't write: id, ``missing`` (array of open, close, first date), ``inert``.

    ``cases``: id, description, start_date (text), recurrence, window_open, window_close, window_first.  A first date that is absent
    but not after publication changes nothing: it is inert.  Rows without either are left out.
    """
    from spanworks.functions.text import date_spellings, quotes, time_spellings

    asked = cases.where((F.col("recurrence") == "daily") & F.col("window_open").isNotNull())
    said = lambda c, spell: F.coalesce(quotes(F.col("description"), spell(c)), F.lit(False))
    lacks = lambda c: F.when(~said(F.col(c), time_spellings), c)
    silent = F.col("window_first").isNotNull() & ~said(F.to_date("window_first"), date_spellings)
    early = F.col("window_first") <= F.left(F.coalesce("start_date", F.lit("")), F.lit(10))
    missing = F.array_compact(F.array(lacks("window_open"), lacks("window_close"), F.when(silent & ~early, "window_first")))
    return asked.select("id", missing.alias("missing"), (silent & early).alias("inert")).where((F.size("missing") > 0) | F.col("inert"))


def truth(rows: DataFrame) -> DataFrame:
    """Add what is true for a reviewed answer: the reviewer's fields where the answer was judged incorrect
    and they gave one, else the answer's own.  Columns model_* and human_* of source, date, time."""
    from spanworks.functions.text import first_said, minute_time

    wrong = F.lower(F.trim("human_verdict")) == "incorrect"
    pick = lambda h, m: F.when(wrong, first_said(F.col(h), F.col(m))).otherwise(first_said(F.col(m)))
    time = F.when(wrong, first_said(minute_time(F.col("human_time")), minute_time(F.col("model_time")))).otherwise(minute_time(F.col("model_time")))
    return rows.withColumns({"true_source": pick("human_source", "model_source"), "true_date": pick("human_date", "model_date"), "true_time": time})


def shadow(notices: DataFrame, recorded: DataFrame, key: str = "id") -> DataFrame:
    """Compare answers of rules with recorded ones: adds ``kind``: never, stale, abstain, recurrence, agree or disagree.

    ``notices``: key, h, source, date, time (source null: abstained); ``recorded``: key, h, source, date, time, recurrence."""
    from spanworks.functions.text import first_said, minute_time

    r = recorded.toDF(*[c if c == key else f"_{c}" for c in recorded.columns])
    same = lambda c: first_said(F.col(c)) == first_said(F.col(f"_{c}"))
    agree = same("source") & same("date") & (minute_time(F.col("time")) == minute_time(F.col("_time")))
    kind = (
        F.when(F.col("_h").isNull(), "never").when(~F.col("h").eqNullSafe(F.col("_h")), "stale").when(F.col("source").isNull(), "abstain")
        .when(first_said(F.col("_recurrence"), F.lit("none")) != "none", "recurrence").when(agree, "agree").otherwise("disagree")
    )
    return notices.join(r, key, "left").withColumn("kind", kind).withColumnRenamed("_source", "recorded_source").drop("_h", "_date", "_time", "_recurrence")


def consequential(events: DataFrame, months: DataFrame, keys: list[str]) -> DataFrame:
    """Events whose class recurrence changes, or outages whose text says that they recur, with their person-hours.

    ``events``: keys, sev, plain_sev, says_recurring; ``months``: keys, us, people."""
    lost = months.groupBy(*keys).agg((F.sum(person_us(F.col("us"), F.col("people"))).cast("double") / 3.6e9).alias("_h"))
    down = (F.col("plain_sev") == "outage") & (F.col("sev") == "degraded")
    missed = (F.col("sev") == "outage") & F.col("says_recurring")
    out = events.where(down | missed).withColumn("effect", F.when(down, "downgraded").otherwise("charged"))
    return out.join(lost, keys, "left").withColumn("person_h", F.bround(F.coalesce("_h", F.lit(0.0))).cast("bigint")).drop("_h")


def recurrence_counts(cases: DataFrame) -> DataFrame:
    """Per tag: notices, hours charged, and hours that one unbroken interval would charge.

    ``cases``: recurrence_tag, start_us, intervals (array of s, e)."""
    us = F.aggregate("intervals", F.lit(0).cast("bigint"), lambda a, i: a + i["e"] - i["s"])
    return cases.groupBy("recurrence_tag").agg(F.count("*").alias("notices"), (F.sum(us) / 3.6e9).alias("hours"), (F.sum(F.element_at("intervals", -1)["e"] - F.col("start_us")) / 3.6e9).alias("unbroken_hours"))


def mixed_events(cases: DataFrame, keys: list[str]) -> DataFrame:
    """Events of which some pins are expanded and some aren't."""
    on = F.col("recurrence_tag").startswith("expanded")
    return cases.groupBy(*keys).agg(F.count("*").alias("pins"), F.count_if(on).alias("expanded")).where("expanded > 0 and expanded < pins")


def window_label(windows, zone: str = "Europe/Dublin"):
    """Opening and closing time of a series, read off its unclipped edges, and its first day."""
    local = lambda us, form: F.date_format(F.from_utc_timestamp(F.timestamp_micros(us), zone), form)
    return F.concat(local(F.get(windows, F.lit(1))["s"], "HH:mm"), F.lit("-"), local(F.get(windows, F.lit(0))["e"], "HH:mm"), F.lit(" from "), local(F.get(windows, F.lit(0))["s"], "yyyy-MM-dd"))


def verdict_tally(reviews: DataFrame) -> DataFrame:
    """Events and person-hours by verdict; blank verdicts are unreviewed."""
    verdict = F.lower(F.trim(F.coalesce("human_verdict", F.lit(""))))
    return reviews.groupBy(F.when(verdict == "", "unreviewed").otherwise(verdict).alias("verdict")).agg(F.count("*").alias("events"), F.sum("person_h").alias("person_h"))
