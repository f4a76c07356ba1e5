"""The extractor against its grammar: forms of times, dates and sentences are put together, and the answers worked out from the parts."""

import datetime as dt
import itertools

import pytest

from spanworks.plans import extract

PUBLISHED = dt.date(2031, 3, 14)
DONE, PLANNED = "completion_update", "scheduled_end_with_time"
DAYS = [dt.date(2031, 3, 20), dt.date(2031, 6, 1), dt.date(2030, 11, 30), dt.date(2032, 2, 29)]


def times():
    """(as written, HH:MM or None where no clock shows it)."""
    for hour, half in itertools.product((1, 6, 11, 12), ("am", "pm")):
        h = hour % 12 + 12 * (half == "pm")
        yield f"{hour}{half}", f"{h:02}:00"
        yield f"{hour}:07{half}", f"{h:02}:07"
        yield f"{hour}.48 {half}", f"{h:02}:48"
    yield from ((f"{h:02}:{m:02}", f"{h:02}:{m:02}") for h, m in ((0, 0), (8, 5), (23, 59)))
    yield from extract.TIMES_OF_DAY.items()
    yield from ((x, None) for x in ("0am", "14pm", "24:30", "10:75pm"))


def dates(day):
    """(as written, the date)."""
    month, nth = f"{day:%B}", f"{day.day}{ {1: 'st', 2: 'nd', 3: 'rd'}.get(day.day % 10 if day.day not in (11, 12, 13) else 0, 'th')}"
    yield f"{day:%d/%m/%Y}", day
    yield f"{day.day}/{day.month}/{day:%y}", day
    yield f"{nth} of {month} {day.year}", day
    yield f"{day.day} {month[:3]} {day.year}", day
    near = [d for y in (-1, 0, 1) if (d := on(PUBLISHED.year + y, day.month, day.day))]
    yield f"the {nth} {month}", min(near, key=lambda d: (abs((d - PUBLISHED).days), d))


def on(year, month, day):
    try:
        return dt.date(year, month, day)
    except ValueError:
        return None


def answer(source, day, clock):
    return (source, str(day), clock) if day and clock else None


def planned():
    """An end that is announced, after each word that announces one."""
    leads = [f"Repairs go on {u}" for u in extract.UNTIL] + [f"There is an {' '.join(e)}" for e in extract.ESTIMATES]
    forms = [(t, d) for day in DAYS for t, d in itertools.product(times(), dates(day))]
    for k, ((said, clock), (date, day)) in enumerate(forms):
        lead = leads[k % len(leads)]
        # an estimate that can't be read is passed over, an "until" leaves the answer open; neither gives one
        yield f"{lead} {said} on {date}. Crews thank you.", answer(PLANNED, day, clock)
    said, clock, day = "4:20pm", "16:20", DAYS[0]
    date = f"{day:%d/%m/%Y}"
    yield f"Valves shut from 9am until {said} on {date}.", answer(PLANNED, day, clock)
    yield f"Valves shut from 9am on {DAYS[2]:%d/%m/%Y} until {said} on {date}.", answer(PLANNED, day, clock)
    yield f"<p>Until <b>{said}</b> on {date}.</p><p>Again: until {said} on {date}</p>", answer(PLANNED, day, clock)
    # nothing is said for sure
    for text in (
        f"Until {said} on {date}, or until 5pm on {date}.", f"Until {said} {date}.", f"Until {date}.", f"Until {said}.", "Until we know more.", f"Until {said} on 31/04/2031.", f"Until {said} on 3 Marchy.",
        f"Every night until {said} on {date}, nightly.", f"Until {said} on 20 and 21 March.", f"Until {said} on 20 March & 21 March.", f"Until {said} on 20 March until 21 March.",
        f"Until {said} on {date}; the notice will be {extract.LIFT[2]} then.", f"{said} on {date}", "", "until", "**", " ",
    ):
        yield text, None


def completed():
    """Each report of completion under a header with the moment."""
    headers = ["**Update {0} {1}**", "**Update {0} on {1}** ", "**{0} {1}**", "**Update: {0} {1}** News.", "**Update {0} {1} "]
    for k, report in enumerate(extract.REPORTS):
        (said, clock), day = list(times())[5 * k % 24], DAYS[k % 4]
        date, day = list(dates(day))[k % 2]
        yield f"{headers[k % 5].format(said, date)}{report}.", answer(DONE, day, clock)
        yield f"{report} at {said} on {date}.", None  # no header
    # fixed values: halves of the day that are answered only where they touch the number
    for half, plus in extract.TOUCHING_HALVES.items():
        yield f"**Update 7:10{half} 20/03/2031** Works are complete.", answer(DONE, DAYS[0], f"{7 + plus:02}:10")
        yield f"**Update 7:10 {half} 20/03/2031** Works are complete.", None
    for word in extract.IRISH_COMPLETE:
        yield f"Tá {word} leis. Until 3pm on 20/03/2031.", None
    # the newest block that reports completion counts, and a report goes before a plan
    yield "**Update 8am 21/03/2031** A crew is there. **Update 6:15am 20/03/2031** Works are complete.", answer(DONE, DAYS[0], "06:15")
    yield "**Update 9pm 20/03/2031** Works are complete. Until 2pm on 25/03/2031.", answer(DONE, DAYS[0], "21:00")
    # of plans only the newest block's counts
    yield "**Update 8am 15/03/2031** Until 6:30pm on 20/03/2031. **Update 7am 14/03/2031** Until 1pm on 16/03/2031.", answer(PLANNED, DAYS[0], "18:30")
    yield "**Update noonish 20/03/2031** Works are complete.", None
    yield "**Update pm 20/03/2031** Works are complete.", None


@pytest.mark.parametrize("forms", [planned, completed])
def test_answers(spark, forms):
    cases = [*forms(), (None, None)]
    df = spark.createDataFrame([(k, f"{PUBLISHED}T06:00:00+00:00", t, "x") for k, (t, _) in enumerate(cases)], "id long, start_date string, description string, _token string")
    got = {r.id: r for r in extract.extract_ends(df).collect()}
    assert len(got) == len(cases)
    wrong = [(t, a, tuple(got[k])[-3:]) for k, (t, a) in enumerate(cases) if (tuple(got[k])[-3:] if got[k].end_source else None) != a]
    assert not wrong, wrong[:10]


@pytest.mark.parametrize("start, text, day", [("2030-12-30", "until 1pm on 2 January", "2031-01-02"), ("2031-01-02", "until 1pm on 30 December", "2030-12-30"), (None, "until 1pm on 2 January", None), (None, "until 1pm on 02/01/2031", "2031-01-02"), ("2031-11-20", "until 1pm on 29 February", "2032-02-29"), ("no date", "until 1pm on 2 January", None)])
def test_years(spark, start, text, day):
    r = extract.extract_ends(spark.createDataFrame([(start, text)], "start_date string, description string")).first()
    assert r.local_date == day


def test_stays_native(spark):
    df = extract.extract_ends(spark.createDataFrame([(str(PUBLISHED), "x")], "start_date string, description string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert df.limit(0).count() == 0
