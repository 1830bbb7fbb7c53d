"""Daily operations reports over the warehouse tables.

Every report takes the warehouse tables as a dict of DataFrames and a
Calendar. Output rows are unordered; pass the result through `in_order` to get
the report's own sort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from quayside.operators.intervals import covering_days, days_covered, days_of_ranges, explode_days, explode_ranges, free_days, running_counts
from quayside.operators.lookup import left_lookup
from quayside.sources.calendar import ATTRIBUTES, Calendar

Tables = Mapping[str, DataFrame]

# Fixed values of the reports: status codes, charge types, subsidiary ids by marina name.
CHECKED_IN = 4
OCCUPYING = (4, 6)
RESERVATION_CHARGES = ("charge-reservation-seasonal", "charge-reservation-transitive")
SUBSIDIARY_BY_NAME = (("Mile High", 8), ("Ray Roberts", 16))
DAYS_PER_TASK = 250_000  # days of stays merged by one task, which holds them all in memory

# The sort each report comes in: (column, ascending). NULLs sort as largest.
ORDERS = {
    "daily_boat_lengths": [("calendar_date", True), ("boat_id", True)],
    "daily_slip_count": [("calendar_date", False), ("marina_name", True)],
    "daily_slip_occupancy": [("calendar_date", True), ("marina_location_id", True), ("slip_id", True)],
    "reservation_rates": [("calendar_date", True), ("reservation_id", True)],
    "daily_rentals": [("calendar_date", True), ("booking_id", True)],
}


def in_order(df: DataFrame, report: str) -> DataFrame:
    """Sort a report as its consumers expect it: NULLs last ascending, first descending."""
    keys = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_first() for c, up in ORDERS[report]]
    return df.orderBy(*keys)


def feet(loa: Column) -> Column:
    """Whole feet of a "feet:inches" text; NULL when there is no colon."""
    return F.when(F.instr(loa, ":") > 0, F.substring_index(loa, ":", 1).try_cast("double"))


def subsidiary_id(name: Column, by_name=SUBSIDIARY_BY_NAME) -> Column:
    """First name pattern that matches decides; 0 when none does."""
    hits = [F.when(name.contains(text), number) for text, number in by_name]
    return F.coalesce(*hits, F.lit(0))


def _countable(slips: DataFrame) -> DataFrame:
    return slips.filter((F.col("active") == 1) & F.col("do_not_count_in_occupancy").isNull())


def daily_boat_lengths(t: Tables, cal: Calendar) -> DataFrame:
    """One row per day, boat and marina with a stay that covers the day (departure day excluded)."""
    stays = t["reservations"].select(
        F.col("id").alias("rid"), "boat_id", "marina_location_id", "scheduled_arrival_time",
        "scheduled_departure_time", (F.col("reservation_status_id") == CHECKED_IN).alias("_in"),
    )
    boats = t["boats"].select(
        "id", F.col("name").alias("boat_name"), "loa", F.col("make").alias("boat_make"), F.col("model").alias("boat_model"))
    marinas = t["marina_locations"].select("id", F.col("name").alias("marina_location_name"))
    arrival, departure = F.col("scheduled_arrival_time"), F.col("scheduled_departure_time")

    # a boat that is not known is no boat; looked up per stay instead of per day of stay
    known = left_lookup(stays, boats.select("id", F.col("id").alias("_boat")), "boat_id", "id", spread_by=[F.col("rid")])
    measures = {"reservation_id": F.col("rid"), "scheduled_arrival_time": arrival, "scheduled_departure_time": departure,
                "occupies_slip": F.coalesce(F.col("_in").cast("int"), F.lit(0))}
    # all measures are maxima: they are taken per boat, marina and aligned range of days, then per day
    ranges = explode_ranges(known, arrival, departure, cal, closed=False).groupBy("_boat", "marina_location_id", "_level", "_place").agg(
        *[F.max(m).alias(n) for n, m in measures.items()])
    # a boat and marina has a few rows per calendar day at most; days are made, and merged, behind this shuffle. It is as
    # wide as there are days: by the bytes of the ranges alone a task's share would grow tenfold and more in memory
    tasks = -(-days_covered(t["reservations"], arrival, departure, cal, closed=False) // DAYS_PER_TASK)
    daily = days_of_ranges(ranges.repartition(max(1, tasks), "_boat", "marina_location_id"), cal).groupBy(
        "_boat", "marina_location_id", "calendar_date").agg(*[F.max(n).alias(n) for n in measures])
    by_group = [F.col("calendar_date"), F.col("reservation_id")]  # days without a boat or a marina may be many
    named = left_lookup(daily, boats, "_boat", "id", spread_by=by_group)
    booked = left_lookup(named, marinas, "marina_location_id", "id", spread_by=by_group).join(cal.days, "calendar_date")
    # a calendar-sided left join would shuffle everything by day; the few empty days come separately
    empty = free_days(t["reservations"], cal.days.limit(1), [], arrival, departure, cal, closed=False).join(cal.days, "calendar_date")
    both = booked.unionByName(empty, allowMissingColumns=True)
    return both.select(
        *ATTRIBUTES,
        F.col("_boat").alias("boat_id"),
        "boat_name",
        feet(F.col("loa")).alias("boat_loa_length"),
        "boat_make", "boat_model", "marina_location_id", "marina_location_name",
        "reservation_id", "scheduled_arrival_time", "scheduled_departure_time",
        F.coalesce("occupies_slip", F.lit(0)).alias("occupies_slip"),
    )


def daily_slip_count(t: Tables, cal: Calendar, subsidiaries=SUBSIDIARY_BY_NAME) -> DataFrame:
    """Active slips per day and marina; both end days count, a NULL end is open."""
    slips = t["slips"].filter("active = 1").select("id", "marina_location_id", "start_date", "end_date")
    marinas = t["marina_locations"].select("id", F.col("id").alias("marina_id"), F.col("name").alias("marina_name"))
    counts = running_counts(
        left_lookup(slips, marinas, "marina_location_id", "id"),
        ["marina_id", "marina_name"], F.col("start_date"), F.col("end_date"), F.col("id"), cal, open_end=True,
    )
    return counts.join(cal.days, "calendar_date").select(
        "calendar_date", "month_year_name", "month_number", "year_number", "marina_name", "marina_id",
        subsidiary_id(F.col("marina_name"), subsidiaries).alias("subid"),
        F.col("n").alias("daily_slip_count"),
    )


def daily_slip_occupancy(t: Tables, cal: Calendar) -> DataFrame:
    """Every countable slip on every day, with each stay that covers it (several if they overlap).

    Occupied rows come from the stays, vacant ones from the stretches of the slip
    no stay covers, found from summed changes per (slip, day): a stay is
    exploded once, and a slip with any number of stays hands at most one row per
    calendar day to its window.
    """
    marinas = t["marina_locations"].select("id", F.col("name").alias("marina_location_name"))
    slips = (
        _countable(t["slips"])
        .select(F.col("id").alias("slip_id"), F.col("name").alias("slip_name"), "marina_location_id")
        .join(marinas, F.col("marina_location_id") == marinas["id"])
        .drop("id")
    )
    status = t["reservation_status"].select("id", F.col("name").alias("reservation_status_name"))
    stays = t["reservations"].select(
        F.col("slip_id").alias("_slip"), F.col("id").alias("reservation_id"), "scheduled_arrival_time",
        "scheduled_departure_time", "reservation_status_id", F.col("name").alias("reservation_name"),
    )
    arrival, departure = F.col("scheduled_arrival_time"), F.col("scheduled_departure_time")

    on_slip = left_lookup(
        stays.join(slips, F.col("_slip") == F.col("slip_id")).drop("_slip"), status, "reservation_status_id", "id"
    )
    occupied = explode_days(on_slip, arrival, departure, cal, closed=False)

    vacant = free_days(on_slip, slips, ["slip_id"], arrival, departure, cal, closed=False).join(slips, "slip_id")
    return (
        occupied.unionByName(vacant, allowMissingColumns=True)
        .join(cal.days, "calendar_date")
        .select(
            *ATTRIBUTES, "slip_id", "slip_name", "marina_location_id", "marina_location_name", "reservation_id",
            "scheduled_arrival_time", "scheduled_departure_time", "reservation_status_id",
            "reservation_status_name", "reservation_name",
            F.when(F.col("reservation_id").isNotNull() & F.col("reservation_status_id").isin(*OCCUPYING), 1)
            .otherwise(0).alias("is_occupied"),
        )
    )


def reservation_rates(t: Tables, cal: Calendar) -> DataFrame:
    """Daily and monthly rates of every checked-in stay, repeated on each of its days (departure day included).

    Charges are reduced to one sum per reservation before they meet the stay,
    and the days are exploded last.
    """
    slips = _countable(t["slips"]).select(F.col("id").alias("_slip_id"), F.col("name").alias("_slip_name"), "recommended_loa")
    marinas = t["marina_locations"].select("id", F.col("name").alias("_marina_name"))
    # a slip seen in two marinas stands for two rows per stay
    berths = left_lookup(
        t["reservations"].select(F.col("slip_id").alias("_berth"), F.col("marina_location_id").alias("_berth_marina"))
        .join(slips, F.col("_berth") == F.col("_slip_id"), "left_semi").distinct()
        .join(slips, F.col("_berth") == F.col("_slip_id")),
        marinas, "_berth_marina", "id",
    )
    stays = t["reservations"].filter(F.col("reservation_status_id") == CHECKED_IN).select(
        F.col("id").alias("reservation_id"), F.col("name").alias("reservation_name"), "reservation_status_id",
        "reservation_type_id", "slip_id", "rate", "scheduled_arrival_time", "scheduled_departure_time",
    )
    status = t["reservation_status"].select("id", F.col("name").alias("reservation_status"))
    kind = t["reservation_types"].select("id", F.col("name").alias("reservation_type"))

    charges = (
        t["invoice_items"]
        .filter(F.col("type_field").isin(*RESERVATION_CHARGES) & (F.col("is_void") == 0) & (F.col("status_field") != "deleted"))
        .groupBy("invoice_id").agg(F.sum("total").alias("_charged"))
        .join(t["invoices"].select(F.col("id").alias("invoice_id"), F.col("reservation_id").alias("_payer")), "invoice_id")
        .groupBy("_payer").agg(F.sum("_charged").alias("_charged"))
    )
    named = left_lookup(left_lookup(stays.join(berths, F.col("slip_id") == F.col("_berth")),
                                    status, "reservation_status_id", "id"), kind, "reservation_type_id", "id")
    # a reservation stands once in the warehouse and has one sum of charges: nothing is left to group
    per_stay = named.join(charges, F.col("reservation_id") == F.col("_payer"), "left").withColumn(
        "invoice_total", F.coalesce("_charged", F.lit(0)))
    arrival, departure = F.col("scheduled_arrival_time"), F.col("scheduled_departure_time")
    days = F.datediff(departure, arrival)
    months = F.months_between(departure, arrival, roundOff=False)
    whole_months = F.round(months, 0)

    def rate(guard: Column, amount: Column, units: Column) -> Column:
        # ten decimal digits take up the binary error of the quotient, so that exact halves round up
        quotient = F.try_divide(amount.cast("double"), units.cast("double")).cast("decimal(28,10)")
        return F.when(guard > 0, F.round(quotient, 2)).otherwise(0)

    rated = per_stay.select(
        "reservation_id", "reservation_name", "reservation_status", "reservation_type",
        "scheduled_arrival_time", "scheduled_departure_time",
        days.alias("reservation_days"),
        F.round(months, 2).alias("reservation_months"),
        F.col("invoice_total").cast("decimal(20,2)").alias("invoice_total"),
        rate(days, F.col("rate"), days).alias("reservation_daily_rate"),
        rate(days, F.col("invoice_total"), days).alias("invoice_daily_rate"),
        rate(whole_months, F.col("rate"), whole_months).alias("reservation_monthly_rate"),
        rate(whole_months, F.col("invoice_total"), months).alias("invoice_monthly_rate"),
    )
    return covering_days(rated, arrival, departure, cal, closed=True).select(*ATTRIBUTES, *rated.columns)


def daily_rentals(t: Tables, cal: Calendar) -> DataFrame:
    """Completed rentals on each day they touch (both ends), with the booking's total shared by its boats.

    Reads the rentals of the last snapshot (`staged_booking_boats`); the boats
    per booking come from the warehouse copy.
    """
    rentals = t["staged_booking_boats"].filter(
        (F.col("status_booking") == "Complete") & F.col("boat_departure").isNotNull()
        & F.col("boat_return").isNotNull() & F.col("boat_id").isNotNull()
    ).select(F.col("id").alias("booking_boat_id"), "booking_id", "boat_id", "boat_departure", "boat_return")
    boats = t["style_boats"].select(F.col("id").alias("boat_id"), "boat_number")
    bookings = t["bookings"].filter("is_canceled = 'No'").select(F.col("id").alias("booking_id"), "boats_total")
    shares = t["booking_boats"].groupBy("booking_id").agg(F.count(F.lit(1)).alias("_boats"))

    # one join per fact key: a booking with very many rentals can then be split
    terms = bookings.join(shares, "booking_id")
    priced = rentals.join(boats, "boat_id").join(terms, "booking_id")
    # whole hours: day part x 24 + hour part, minutes dropped
    hours = F.timestamp_diff("HOUR", F.col("boat_departure"), F.col("boat_return"))
    rated = priced.select(
        "booking_boat_id", "boat_id", "boat_number", "boat_departure", "boat_return", "booking_id",
        hours.alias("hours"), "boats_total",
        F.round(F.col("boats_total") / F.col("_boats"), 2).alias("rate_per_boat"),
        # no whole hour, no hourly rate
        F.round(F.try_divide(F.col("boats_total"), F.col("_boats") * hours), 2).alias("rate_per_boat_per_hour"),
    )
    return covering_days(rated, F.col("boat_departure"), F.col("boat_return"), cal, closed=True).select(
        *ATTRIBUTES, *rated.columns
    )
