"""End times from templated notice text; what the templates can't answer for sure is left open.

A text becomes an array of tokens: runs of digits, runs of letters, runs of stars and
single signs, each with a mark whether it touches the token before it.  Update blocks
are slices of that array.  Times and dates are read by position, from small tables of words;
everything is a column expression, one row at a time, without a join or a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.functions.arrays import let, lookup
from spanworks.functions.text import describes_recurrence, strip_markup
from spanworks.functions.times import calendar_date, nearest_year

# Words that the notices use for months, halves of the day (the Irish ones only where
# they touch the number), times of day, ends, withdrawals, and the parts of the sentence that reports completion.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
HALVES = {"am": 0, "pm": 12, "ppm": 12}
TOUCHING_HALVES = {"rn": 0, "in": 12}
TIMES_OF_DAY = {"midday": "12:00", "noon": "12:00", "midnight": "00:00"}
UNTIL = ["until", "unil", "till"]
LIFT = ["lift", "lifts", "lifted", "lifting"]
SUBJECTS, VERBS, COMPLETE = ["work", "works"], ["are", "is", "were", "have been", "has been"], "complete"
IRISH_COMPLETE = ["crioch", "críoch"]
ESTIMATES = [["estimated", "completion", "time", "of"], ["estimated", "restoration", "time", "of"]]

MONTH_NUMBER = {name: k + 1 for k, full in enumerate(MONTHS) for name in (full, full[:3])}
REPORTS = [f" {s} {v} {now}{COMPLETE}" for s in SUBJECTS for v in VERBS for now in ("", "now ")]


def tokens(plain: Column) -> Column:
    """The tokens of a text in lower case: ``w``, and ``touch`` if no space stands before; ordinal endings are dropped."""
    bare = F.regexp_replace(F.lower(plain), r"(?<=\d)(?:st|nd|rd|th)\b", "")
    raw = F.regexp_extract_all(bare, F.lit(r" ?(?:\*{2,}|\d+|\p{L}+|\S)"), F.lit(0))
    return F.transform(raw, lambda x: F.struct(F.ltrim(x).alias("w"), (~F.startswith(x, F.lit(" "))).alias("touch")))


class Reader:
    """Looks at tokens by their distance from the first one."""

    def __init__(self, block: Column, at: Column | int = 0):
        self.block, self.at = block, at

    def token(self, k: int) -> Column:
        return F.get(self.block, F.lit(k) if isinstance(self.at, int) else self.at + k)

    def word(self, k: int = 0) -> Column:
        return self.token(k)["w"]

    def touches(self, k: int) -> Column:
        return F.coalesce(self.token(k)["touch"], F.lit(False))

    def number(self, k: int, least: int, most: int) -> Column:
        """Whether a token is a number of so many digits."""
        return F.coalesce(self.word(k).rlike(rf"^\d{{{least},{most}}}$"), F.lit(False))

    def ends(self, k: int) -> Column:
        """Whether the token before ``k`` ends a word there."""
        return ~(self.touches(k) & F.coalesce(self.word(k).rlike(r"^[\p{L}\d_]"), F.lit(False)))

    def joined(self, k: int, *signs: str) -> Column:
        return F.coalesce(self.word(k).isin(*signs), F.lit(False)) & self.touches(k)


def _found(value: Column, size: int) -> Column:
    return F.struct(value.alias("value"), F.lit(size).alias("size"))


def clock(t: Column) -> Column:
    """(value, size): the HH:MM that the first tokens write, null where no clock shows it, and how many they are; null if they write no time."""
    r = Reader(t)
    split = r.joined(1, ":", ".") & r.number(2, 2, 2) & r.touches(2)
    shift = lambda k: F.coalesce(lookup(HALVES, r.word(k)), F.when(r.touches(k), lookup(TOUCHING_HALVES, r.word(k))))

    def twelve(minute: Column, half: Column) -> Column:
        h, m = r.word().cast("int"), minute.cast("int")
        return F.when(h.between(1, 12) & (m <= 59), F.format_string("%02d:%02d", h % 12 + half, m))

    h24, m24 = r.word().cast("int"), r.word(2).cast("int")
    named = lookup(TIMES_OF_DAY, r.word())
    hour = r.number(0, 1, 2)
    return (
        F.when(named.isNotNull() & r.ends(1), _found(named, 1))
        .when(hour & split & shift(3).isNotNull() & r.ends(4), _found(twelve(r.word(2), shift(3)), 4))
        .when(hour & shift(1).isNotNull() & r.ends(2), _found(twelve(F.lit("00"), shift(1)), 2))
        .when(hour & split & (r.word(1) == ":") & r.ends(3), _found(F.when((h24 < 24) & (m24 < 60), F.format_string("%02d:%02d", h24, m24)), 3))
    )


def day_of(t: Column, published: Column) -> Column:
    """The date that the first tokens write as (value), in the year nearest to publication where none is given; null as in :func:`clock`."""
    r = Reader(t)
    slashes = r.number(0, 1, 2) & r.joined(1, "/") & r.number(2, 1, 2) & r.touches(2) & r.joined(3, "/") & r.number(4, 2, 4) & r.touches(4) & r.ends(5)
    year = r.word(4).cast("int")
    written = calendar_date(F.when(year < 100, year + 2000).otherwise(year), r.word(2).cast("int"), r.word().cast("int"))

    def spelled(rest: Column) -> Column:
        x = Reader(rest)
        month, day = lookup(MONTH_NUMBER, x.word()), r.word().cast("int")
        dated = x.number(1, 4, 4) & ~x.touches(1) & x.ends(2)
        date = F.when(dated, calendar_date(x.word(1).cast("int"), month, day)).otherwise(nearest_year(day, month, published))
        return F.when(month.isNotNull() & ~x.touches(0) & (dated | x.ends(1)), F.struct(date.alias("value")))

    rest = F.slice(t, F.when(r.word(1) == "of", 3).otherwise(2), 4)
    return F.when(slashes, F.struct(written.alias("value"))).when(r.number(0, 1, 2) & ~r.touches(1), let(rest, spelled))


def moment(t: Column, published: Column, on: bool) -> Column:
    """(date, time) where the first tokens write a time, ``on`` (it may lack in headers) and a date, else null."""

    def dated(c: Column, rest: Column) -> Column:
        r = Reader(rest)
        said = F.coalesce(r.word() == "on", F.lit(False))
        the = said & F.coalesce(r.word(1) == "the", F.lit(False)) if on else F.lit(False)
        from_ = F.when(said, 2).otherwise(1) + F.when(the, 1).otherwise(0)
        read = F.when(said | F.lit(not on), let(F.slice(rest, from_, 8), lambda x: day_of(x, published)))
        return let(read, lambda d: F.when(d.isNotNull(), F.struct(F.date_format(d["value"], "yyyy-MM-dd").alias("date"), c["value"].alias("time"))))

    return let(clock(t), lambda c: F.when(c.isNotNull(), let(F.slice(t, c["size"] + 1, 10), lambda rest: dated(c, rest))))


def _is_header(block: Column, at: Column) -> Column:
    r = Reader(block, at)
    return F.coalesce(F.startswith(r.word(), F.lit("**")) & (((r.word(1) == "update") & r.ends(2)) | r.number(1, 1, 99)), F.lit(False))


def blocks(t: Column) -> Column:
    """Slices of the tokens, the newest first: each update header opens one, what stands before the first is one too."""
    heads = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | _is_header(t, i))
    cut = let(heads, lambda h: F.transform(h, lambda at, k: F.slice(t, at + 1, F.coalesce(F.get(h, k + 1), F.size(t)) - at)))
    return F.when(F.size(t) > 0, cut).otherwise(F.array().cast("array<array<struct<w:string,touch:boolean>>>"))


def _spaced(block: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(F.transform(block, lambda x: x["w"]), " "), F.lit(" "))


def _says(text: Column, phrases: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(text, p))


def _completed(block: Column, published: Column) -> Column:
    """The moment in a block's header, if it has one."""
    r = Reader(block)
    named = F.coalesce(r.word(1) == "update", F.lit(False)).cast("int")
    sign = lambda k: F.coalesce(r.word(k).isin(":", "."), F.lit(False)).cast("int")
    from_ = named * (1 + sign(2) * (1 + sign(3))) + 2
    return F.when(_is_header(block, F.lit(0)), let(F.slice(block, from_, 16), lambda t: moment(t, published, on=False)))


def _lists_days(t: Column) -> Column:
    """Whether two days stand beside an "and": ``26 and 27 May``, ``26 May and 27 May``."""

    def beside(i: Column) -> Column:
        r = Reader(t, i)
        joins = r.word().isin("and", "&")
        right = r.number(1, 1, 2) & lookup(MONTH_NUMBER, r.word(2)).isNotNull()
        left = r.number(-1, 1, 9) | (lookup(MONTH_NUMBER, r.word(-1)).isNotNull() & r.number(-2, 1, 9))
        return F.coalesce(joins & right & left, F.lit(False))

    return F.exists(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(t))), lambda i: beside(i)) | beside(F.lit(1))


def _scheduled(block: Column, published: Column) -> Column:
    """The one end that a block states; null if an "until" can't be read in full, an end is no real date, or there are several."""

    def place(i: Column) -> Column:
        """Where the moment after an until or an estimate starts, and whether it must be one."""
        r = Reader(block, i)
        estimate = F.lit(False)
        for p in ESTIMATES:
            same = F.lit(True)
            for k, w in enumerate(p):
                same = same & (r.word(k) == w)
            estimate = estimate | same
        return F.when(r.word().isin(UNTIL), F.struct((i + 2).alias("from"), F.lit(True).alias("must"))).when(estimate, F.struct((i + 5).alias("from"), F.lit(False).alias("must")))

    def one(ends: Column) -> Column:
        sure = ~F.exists(ends, lambda m: m.isNull() | m["date"].isNull() | m["time"].isNull())
        return F.when(sure & (F.size(F.array_distinct(ends)) == 1), F.get(ends, F.lit(0)))

    # few positions hold a word that announces an end; only these are looked at closely
    openers = sorted({*UNTIL, *(p[0] for p in ESTIMATES)})
    held = F.filter(F.sequence(F.lit(0), F.size(block)), lambda i: F.get(block, i)["w"].isin(openers))
    places = F.filter(F.transform(held, place), lambda x: x.isNotNull())
    read = F.transform(places, lambda p: F.struct(p["must"].alias("must"), let(F.slice(block, p["from"], 16), lambda t: moment(t, published, on=True)).alias("m")))
    return let(F.transform(F.filter(read, lambda x: x["must"] | x["m"].isNotNull()), lambda x: x["m"]), one)


def _answer(t: Column, description: Column, published: Column) -> Column:
    def of_blocks(all_: Column) -> Column:
        telling = F.transform(all_, lambda b: let(_spaced(b), lambda s: F.struct(b.alias("b"), _says(s, REPORTS).alias("done"), _says(s, IRISH_COMPLETE).alias("irish"))))

        def decide(first: Column) -> Column:
            done = F.when(first["done"], _completed(first["b"], published))
            shut = describes_recurrence(description) | F.exists(t, lambda x: x["w"].isin(LIFT)) | _lists_days(t)
            planned = F.when(first.isNull() & ~shut, let(F.get(all_, F.lit(0)), lambda newest: _scheduled(newest, published)))
            pair = lambda source, m: F.when(m["date"].isNotNull() & m["time"].isNotNull(), F.struct(F.lit(source).alias("end_source"), m["date"].alias("local_date"), m["time"].alias("local_time")))
            return F.coalesce(let(done, lambda m: pair("completion_update", m)), let(planned, lambda m: pair("scheduled_end_with_time", m)))

        return let(F.get(F.filter(telling, lambda x: x["done"] | x["irish"]), F.lit(0)), decide)

    return let(blocks(t), of_blocks)


def extract_ends(notices: DataFrame) -> DataFrame:
    """Add ``end_source``, ``local_date``, ``local_time`` (null: no answer) to notices with ``start_date`` and ``description``.

    Null and empty texts have no answer; a start that is no date answers only texts that write the year.
    Texts without a word that could end anything aren't read further.
    """
    plain = strip_markup(F.col("description"))
    may = F.lower(plain).rlike("|".join(sorted({*UNTIL, *(p[0] for p in ESTIMATES), COMPLETE})))
    published = F.try_to_date(F.left(F.col("start_date"), F.lit(10)), "yyyy-MM-dd")
    found = F.when(may, let(tokens(plain), lambda t: _answer(t, F.col("description"), published)))
    # exploding an array of one keeps later projections from reading the text again
    out = notices.select("*", F.explode(F.array(found)).alias("_answer"))
    return out.select(*notices.columns, "_answer.end_source", "_answer.local_date", "_answer.local_time")
