"""Text columns of notices: markup, categories, schemes, recurrence wording, quoted times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording that announces a window repeating over a range of dates, wording that
# announces low pressure and no loss of supply, and words that say nothing about which supply scheme is meant.
RECURRENCE = r"\b(daily|nightly|each night|every night|each day|overnight (?:from|between))\b"
PRESSURE_ONLY = ["may cause low pressure to", "may cause severe low pressure to"]
SCHEME_NOISE = ["public", "water", "supply", "scheme", "regional", "pws", "the"]


def collapse(c: Column) -> Column:
    """Runs of white space, the no-break ones included, become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_markup(c: Column) -> Column:
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "))


def category_prefix(title: Column) -> Column:
    """The part of a title before the first dash that a space follows, in lower case."""
    return collapse(F.lower(F.split(title, r"\s*[–-]\s+", 2)[0]))


def scheme_key(location: Column) -> Column:
    """A location reduced to the words that name its scheme; empty if none is left."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(location, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(SCHEME_NOISE)), " ")


def describes_recurrence(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "<[^>]+>", " ").rlike(RECURRENCE)


def only_pressure(text: Column) -> Column:
    """Whether a text announces low pressure alone; one that announces disruptions as well doesn't count."""
    return F.lower(F.coalesce(text, F.lit(""))).rlike("|".join(rf"{x}\b" for x in PRESSURE_ONLY))


def title_case(c: Column) -> Column:
    """Upper case after every non-letter, lower case elsewhere."""
    parts = F.split(c, r"(?<=[^\p{L}])|(?=[^\p{L}])")
    return F.array_join(F.transform(parts, F.initcap), "")


def event_key(ref: Column, row_id: Column) -> Column:
    """A notice's reference number, or a key of its own where it has none."""
    return F.coalesce(F.nullif(ref, F.lit("")), F.concat(F.lit("id:"), row_id.cast("string")))


def text_hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def time_spellings(t: Column) -> Column:
    """Ways in which a text can write an HH:MM time, in lower case."""
    hour, minute = F.substring(t, 1, 2).cast("int"), F.substring(t, 4, 2)
    twelve = F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string")
    half = F.when(hour < 12, "am").otherwise("pm")
    bare = F.when(minute == "00", F.array(twelve)).otherwise(F.array().cast("array<string>"))
    stems = F.concat(bare, F.array(F.concat(twelve, F.lit(":"), minute), F.concat(twelve, F.lit("."), minute)))
    halves = F.flatten(F.transform(stems, lambda x: F.array(F.concat(x, half), F.concat(x, F.lit(" "), half))))
    return F.concat(F.array(F.left(t, F.lit(5)), F.concat(hour.cast("string"), F.lit(":"), minute)), halves)


def ordinal(day: Column) -> Column:
    """The ending of a day's number: st, nd, rd or th."""
    return F.when(day.between(11, 13), "th").when(day % 10 == 1, "st").when(day % 10 == 2, "nd").when(day % 10 == 3, "rd").otherwise("th")


def date_spellings(d: Column) -> Column:
    """Ways in which a text can write a date, in lower case."""
    day, month = F.dayofmonth(d), F.lower(F.date_format(d, "MMMM"))
    n, said = day.cast("string"), F.concat(day.cast("string"), ordinal(day))
    spelled = [F.concat(n, F.lit(" "), month), F.concat(F.date_format(d, "dd"), F.lit(" "), month), F.concat(n, F.lit(" "), F.left(month, F.lit(3))), F.concat(said, F.lit(" "), month), F.concat(said, F.lit(" of "), month)]
    return F.array(*spelled, *[F.date_format(d, form) for form in ("d/MM", "dd/MM", "d/M", "d-MM", "dd-MM")])


def quotes(text: Column, spellings: Column) -> Column:
    """Whether a text holds one of the spellings."""
    plain = F.lower(strip_markup(text))
    return F.exists(spellings, lambda s: F.contains(plain, s))


# Reporting areas whose county isn't their own name without CITY.
COUNTY_OF = {"DUBLIN CITY": "Dublin", "DUN LAOGHAIRE/RATHDOWN": "Dublin", "FINGAL": "Dublin", "SOUTH DUBLIN": "Dublin", "NORTH TIPPERARY": "Tipperary", "SOUTH TIPPERARY": "Tipperary"}


def county_of(area: Column) -> Column:
    """The traditional county of a reporting area."""
    pairs = F.create_map(*[F.lit(x) for kv in COUNTY_OF.items() for x in kv])
    return F.coalesce(pairs[area], title_case(F.regexp_replace(area, " CITY$", "")))


def elsewhere_label(settlement: Column) -> Column:
    return F.concat(F.lit("Elsewhere in "), F.replace(settlement, F.lit(" and suburbs"), F.lit("")))


def around_label(division: Column) -> Column:
    return F.concat(F.lit("Around "), division)


def minute_time(t: Column) -> Column:
    """A time to the minute, empty for none."""
    return F.left(F.trim(F.coalesce(t, F.lit(""))), F.lit(5))


def first_said(*columns: Column) -> Column:
    """The first column that isn't blank, trimmed; empty if all are."""
    return F.coalesce(*[F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit("")) for c in columns], F.lit(""))


def availability_text(availability: Column, person_h: Column) -> Column:
    """Three decimals; a month with any loss never shows as whole."""
    return F.concat(F.format_string("%.3f", F.when(person_h > 0, F.least(availability, F.lit(99.999))).otherwise(availability)), F.lit("%"))
