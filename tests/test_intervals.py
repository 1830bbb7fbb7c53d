"""Interval joins against the plain theta join on small data."""

from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quayside.operators.intervals import covering_days, explode_days, free_days, running_counts
from quayside.operators.lookup import left_lookup
from quayside.plans import views
from quayside.sources.calendar import Calendar

FIRST, LAST = date(2024, 1, 5), date(2024, 1, 25)
stamps = st.one_of(st.none(), st.datetimes(datetime(2024, 1, 1), datetime(2024, 1, 31, 23, 59)))
intervals = st.lists(st.tuples(st.sampled_from(["a", "b", None]), stamps, stamps), max_size=12)
quick = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DDL = "g string, s timestamp_ntz, e timestamp_ntz"


def _days():
    return [FIRST + timedelta(days=i) for i in range((LAST - FIRST).days + 1)]


def _covers(day, s, e, closed, open_end=False):
    if s is None or (e is None and not open_end):
        return False
    return s.date() <= day and (e is None or day <= e.date() if closed else day < e.date())


@quick
@given(intervals, st.booleans())
def test_explode_days(spark, rows, data, closed):
    cal = Calendar.between(spark, FIRST, LAST)
    df = rows("id int, " + DDL, *[(i, *r) for i, r in enumerate(data)])
    got = sorted((r["id"], r["calendar_date"]) for r in explode_days(df, F.col("s"), F.col("e"), cal, closed=closed).collect())
    assert got == sorted((i, d) for i, (_, s, e) in enumerate(data) for d in _days() if _covers(d, s, e, closed))


@quick
@given(intervals, st.booleans())
def test_free_days(spark, rows, data, closed):
    cal = Calendar.between(spark, FIRST, LAST)
    df = rows(DDL, *data)
    got = sorted(r["calendar_date"] for r in free_days(df, cal.days.limit(1), [], F.col("s"), F.col("e"), cal, closed=closed).collect())
    assert got == [d for d in _days() if not any(_covers(d, s, e, closed) for _, s, e in data)]


@quick
@given(intervals, st.booleans())
def test_running_counts(spark, rows, data, open_end):
    cal = Calendar.between(spark, FIRST, LAST)
    df = rows("id int, " + DDL, *[(i if i % 3 else None, *r) for i, r in enumerate(data)])
    got = {(r["g"], r["calendar_date"]): (r["alive"], r["n"])
           for r in running_counts(df, ["g"], F.col("s"), F.col("e"), F.col("id"), cal, open_end=open_end).collect()}
    want = {}
    for i, (g, s, e) in enumerate(data):
        for d in _days():
            if _covers(d, s, e, True, open_end):
                alive, n = want.get((g, d), (0, 0))
                want[(g, d)] = (alive + 1, n + (1 if i % 3 else 0))
    assert got == want


def test_calendar_with_gaps(spark, rows):
    full = Calendar.between(spark, FIRST, LAST)
    cal = Calendar.of(full.days.filter("calendar_date <> date'2024-01-10'"))
    assert (cal.first, cal.last) == (FIRST, LAST)
    df = rows("s timestamp_ntz, e timestamp_ntz", (datetime(2024, 1, 9), datetime(2024, 1, 12)))
    days = [r["calendar_date"].day for r in covering_days(df, F.col("s"), F.col("e"), cal, closed=False).collect()]
    assert sorted(days) == [9, 11]


def test_no_count_down(spark, rows):
    df = rows("s timestamp_ntz, e timestamp_ntz", (datetime(2024, 1, 20), datetime(2024, 1, 10)))
    assert explode_days(df, F.col("s"), F.col("e"), Calendar.between(spark, FIRST, LAST), closed=True).count() == 0


def test_lookup_with_placeholders(rows):
    """NULL and placeholder keys are spread; results are those of a plain left join, also if the dimension knows the placeholder."""
    facts = rows("id int, k bigint", *[(i, [None, -99999, 1, 2, 3][i % 5]) for i in range(50)])
    for dim in (rows("id bigint, name string", (1, "x"), (2, "y"), (2, "z")), rows("id bigint, name string", (-99999, "none"), (1, "x"))):
        plain = left_lookup(facts, dim, "k", "id").collect()
        spread = left_lookup(facts, dim, "k", "id", placeholders=(-99999,), spread_by=[F.col("id")]).collect()
        assert sorted(map(str, plain)) == sorted(map(str, spread))


def test_boats_and_empty_days(spark, rows):
    """A day without stays is kept; stays of unknown boats share one NULL group; length needs a colon."""
    cal = Calendar.between(spark, date(2024, 1, 1), date(2024, 1, 3))
    t = {
        "reservations": rows(
            "id bigint, boat_id bigint, marina_location_id bigint, reservation_status_id bigint, "
            "scheduled_arrival_time timestamp_ntz, scheduled_departure_time timestamp_ntz",
            (1, 7, 1, 4, datetime(2024, 1, 1, 9), datetime(2024, 1, 2, 9)),
            (2, 99, 1, 1, datetime(2024, 1, 1, 9), datetime(2024, 1, 2, 9)),
            (3, None, 1, 4, datetime(2024, 1, 1, 9), datetime(2024, 1, 2, 9)),
            (4, 7, 1, 4, datetime(2024, 1, 2, 9), datetime(2024, 1, 2, 20))),
        "boats": rows("id bigint, name string, loa string, make string, model string", (7, "Gull", "32:6", "m", "n")),
        "marina_locations": rows("id bigint, name string", (1, "North")),
    }
    got = {(r["calendar_date"].day, r["boat_id"]): (r["reservation_id"], r["boat_loa_length"], r["occupies_slip"])
           for r in views.daily_boat_lengths(t, cal).collect()}
    assert got == {(1, 7): (1, 32.0, 1), (1, None): (3, None, 1), (2, None): (None, None, 0), (3, None): (None, None, 0)}


def test_report_order(rows):
    df = rows("calendar_date date, marina_name string", (date(2024, 1, 1), "b"), (date(2024, 1, 2), None), (date(2024, 1, 2), "a"))
    assert [r["marina_name"] for r in views.in_order(df, "daily_slip_count").collect()] == ["a", None, "b"]


def test_aligned_ranges_cover_each_day_once(spark, rows):
    import random
    from datetime import date, timedelta

    from quayside.operators.intervals import days_of_ranges, explode_ranges

    rnd, first = random.Random(1), date(2024, 1, 1)
    cal = Calendar.between(spark, first, date(2024, 12, 30))
    spans = [(i, first + timedelta(rnd.randint(-40, 380)), rnd.choice([0, 1, 2, 7, 64, 365, 900])) for i in range(200)]
    spans = [(i, s, s + timedelta(n)) for i, s, n in spans] + [(900, None, first), (901, first, None), (902, first + timedelta(5), first)]
    for closed in (True, False):
        ranges = explode_ranges(rows("id int, s date, e date", *spans), F.col("s"), F.col("e"), cal, closed=closed)
        most = ranges.groupBy("id").count().agg(F.max("count")).first()[0]
        got = sorted(map(tuple, days_of_ranges(ranges, cal).select("id", "calendar_date").collect()))
        want = sorted((i, d) for i, s, e in spans if s and e for k in range(366)
                      if (d := first + timedelta(k)) <= cal.last and s <= d and (d <= e if closed else d < e))
        assert got == want and most <= 2 * 9


def test_more_days_of_stays_are_merged_by_more_tasks(spark, rows, monkeypatch):
    from quayside.operators.intervals import days_covered, explode_days

    cal = Calendar.between(spark, date(2024, 1, 1), date(2024, 3, 31))
    spans = [(i, i % 3, 1, 4, datetime(2024, 1, 1 + i), datetime(2024, 1, 20 + i)) for i in range(6)] + [
        (7, None, 1, 4, datetime(2023, 1, 1), datetime(2025, 1, 1)), (8, 1, None, 4, None, datetime(2024, 1, 2)),
        (9, 1, 1, 4, datetime(2024, 2, 2), datetime(2024, 2, 1))]
    t = {
        "reservations": rows("id bigint, boat_id bigint, marina_location_id bigint, reservation_status_id bigint, "
                             "scheduled_arrival_time timestamp_ntz, scheduled_departure_time timestamp_ntz", *spans),
        "boats": rows("id bigint, name string, loa string, make string, model string", *[(i, "Gull", "32:6", "m", "n") for i in range(3)]),
        "marina_locations": rows("id bigint, name string", (1, "North")),
    }
    start, end = F.col("scheduled_arrival_time"), F.col("scheduled_departure_time")
    days = explode_days(t["reservations"], start, end, cal, closed=False).count()
    assert days_covered(t["reservations"], start, end, cal, closed=False) == days == 6 * 19 + 91
    assert days_covered(t["reservations"].limit(0), start, end, cal, closed=False) == 0
    want = sorted(map(repr, views.daily_boat_lengths(t, cal).collect()))
    for per_task, tasks in ((10, 21), (100, 3)):
        monkeypatch.setattr(views, "DAYS_PER_TASK", per_task)
        got = views.daily_boat_lengths(t, cal)
        assert sorted(map(repr, got.collect())) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert f", {tasks}\n" in "\n".join(x for x in plan.splitlines() if "RepartitionByExpression" in x) + "\n"
