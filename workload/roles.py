"""The supplied test tables in the roles of warehouse tables.

A role is a projection of one whole supplied table. Its expressions are plain
SQL that Spark and DuckDB both read, except for the few helpers of `Dialect`.
"""

from __future__ import annotations

from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayside.sources.calendar import Calendar

STAYS_FROM, STAYS_TO = date(1995, 1, 1), date(2001, 12, 31)
RENTALS_FROM, RENTALS_TO = date(2024, 1, 1), date(2024, 2, 29)


class SparkDialect:
    def plus(self, ts, days="0", hours="0", minutes="0"):
        return f"({ts} + make_dt_interval(cast({days} as int), cast({hours} as int), cast({minutes} as int)))"

    def period(self, ts):
        return f"date_format({ts}, 'MMM yyyy')"

    def stamp(self, text):
        return f"timestamp_ntz'{text}'"


class DuckDialect:
    def plus(self, ts, days="0", hours="0", minutes="0"):
        return (f"({ts} + to_days(cast({days} as integer)) + to_hours(cast({hours} as bigint))"
                f" + to_minutes(cast({minutes} as bigint)))")

    def period(self, ts):
        return f"strftime({ts}, '%b %Y')"

    def stamp(self, text):
        return f"timestamp '{text}'"


def _roles(d) -> dict[str, tuple[str, dict[str, str]]]:
    """role -> (supplied table, {column: expression}); a leading "distinct " reduces the role to distinct rows."""
    ym = "cast(year(o_orderdate) * 100 + month(o_orderdate) as bigint)"
    return {
        "reservations": ("orders", {
            "id": "o_orderkey",
            "name": "'Stay ' || cast(o_orderkey as string)",
            "marina_location_id": "case when o_orderkey % 41 = 0 then null else cast(floor(o_custkey / 15) as bigint) % 25 "
                                  "+ case when o_orderkey % 401 = 0 then 1 else 0 end end",
            "reservation_status_id": "o_orderkey % 7",
            "reservation_type_id": "cast(substr(o_orderpriority, 1, 1) as bigint)",
            "boat_id": "case when o_orderkey % 53 = 0 then null when o_orderkey % 43 = 0 then o_custkey + 1000000000 else o_custkey end",
            "slip_id": "case when o_orderkey % 59 = 0 then null else cast(floor(o_custkey / 15) as bigint) end",
            "scheduled_arrival_time": d.plus("o_orderdate", "0", "o_orderkey % 24"),
            "scheduled_departure_time": "case when o_orderkey % 37 = 0 then null else "
            + d.plus("o_orderdate", "case when o_orderkey % 7 = 4 then o_orderkey % 90 else o_orderkey % 15 end",
                     "(o_orderkey * 5) % 24") + " end",
            "rate": "cast(o_totalprice / 1000 as decimal(10,0))",
        }),
        "slips": ("supplier", {
            "id": "s_suppkey",
            "name": "s_name",
            "marina_location_id": "cast(s_nationkey as bigint)",
            "active": "case when s_suppkey % 5 = 0 then 0 when s_suppkey % 17 = 1 then null else 1 end",
            "do_not_count_in_occupancy": "case when s_suppkey % 6 = 1 then 1 when s_suppkey % 6 = 2 then 0 else null end",
            "start_date": d.plus(d.stamp("1995-01-01 00:00:00"), "s_suppkey % 700", "s_suppkey % 24"),
            "end_date": "case when s_suppkey % 3 = 0 then null else "
            + d.plus(d.stamp("1996-06-01 00:00:00"), "s_suppkey % 1500", "s_suppkey % 24") + " end",
            "recommended_loa": "cast(s_suppkey % 60 as string) || ':0'",
        }),
        "boats": ("customer", {
            "id": "c_custkey",
            "name": "c_name",
            "loa": "case when c_custkey % 11 = 0 then cast(c_custkey % 60 as string) when c_custkey % 13 = 0 then 'n/a:3' "
                   "else cast(c_custkey % 60 as string) || ':' || cast(c_custkey % 12 as string) end",
            "make": "c_mktsegment",
            "model": "'M' || cast(c_nationkey as string)",
        }),
        "marina_locations": ("nation", {
            "id": "cast(n_nationkey as bigint)",
            "name": "case n_nationkey when 3 then 'Mile High Marina' when 5 then 'Lake Ray Roberts' else n_name end",
        }),
        "reservation_status": ("nation", {"id": "cast(n_nationkey as bigint)", "name": "n_name"}),
        "reservation_types": ("region", {"id": "cast(r_regionkey as bigint)", "name": "r_name"}),
        "invoices": ("orders", {
            "id": "o_orderkey",
            "reservation_id": "cast(floor(o_orderkey / 2) * 2 as bigint)",
            "total": "cast(o_totalprice as decimal(9,2))",
        }),
        "invoice_items": ("lineitem", {
            "id": "l_orderkey * 10 + l_linenumber",
            "invoice_id": "l_orderkey",
            "total": "cast(l_extendedprice as decimal(9,2))",
            "type_field": "case l_returnflag when 'A' then 'charge-reservation-seasonal' when 'N' then 'charge-reservation-transitive' else 'charge-other' end",
            "is_void": "case when l_linestatus = 'F' and l_quantity > 40 then 1 else 0 end",
            "status_field": "case l_linenumber when 7 then null when 6 then 'deleted' else 'open' end",
        }),
        "booking_boats": ("events", {
            "id": "event_id",
            "booking_id": "cast(floor(event_id / 3) as bigint)",
            "boat_id": "case when event_id % 29 = 0 then null else user_id end",
            "boat_departure": "ts",
            "boat_return": "case when event_id % 31 = 0 then null else "
            + d.plus("ts", "0", "event_id % 50", "event_id % 60") + " end",
            "status_booking": "case event_type when 'error' then 'Cancelled' else 'Complete' end",
        }),
        "bookings": ("orders", {
            "id": "o_orderkey",
            "boats_total": "cast(o_totalprice as decimal(10,2))",
            "is_canceled": "case o_orderstatus when 'P' then 'Yes' else 'No' end",
        }),
        "style_boats": ("customer", {"id": "c_custkey", "boat_number": "c_name"}),
        # accounting
        "header": ("orders", {
            "id": "o_orderkey",
            "tranid": "'T' || cast(o_orderkey as string)",
            "trandate": "cast(o_orderdate as date)",
            "postingperiod": ym,
            "posting": "case when o_orderstatus = 'P' and month(o_orderdate) = 12 then 'F' else 'T' end",
            "kind": "substr(o_orderpriority, 1, 1) || o_orderstatus",
        }),
        "line": ("lineitem", {
            "id": "cast(l_linenumber as bigint)",
            "transaction": "l_orderkey",
            "trandisplayname": "'Line ' || cast(l_orderkey as string) || '/' || cast(l_linenumber as string)",
            "subsidiary": "l_partkey % 6",
            "location": "l_suppkey % 25",
            "class": "l_partkey % 30",
            "department": "l_suppkey % 5",
            "entity": "case when l_linenumber = 2 then null else l_suppkey end",
            "vendor": "l_suppkey",
            "customer": "l_partkey",
            "item": "l_partkey",
            "account": "l_partkey",
            "expenseaccount": "l_suppkey",
            "quantity": "cast(l_quantity as decimal(12,2))",
            "accountingbook_credit": "case l_returnflag when 'R' then null else cast(l_extendedprice as decimal(12,2)) end",
            "accountingbook_debit": "case l_linestatus when 'F' then cast(l_quantity as decimal(12,2)) else null end",
            "creditforeignamount": "cast(l_extendedprice as decimal(12,2))",
            "debitforeignamount": "cast(l_quantity as decimal(12,2))",
            "memo": "case l_linenumber when 1 then null else l_returnflag || l_linestatus end",
        }),
        "account": ("part", {
            "id": "p_partkey",
            "acctnumber": "cast(4000 + p_size as string)",
            "accttype": "case p_type when 'STANDARD' then 'Income' when 'ECONOMY' then 'COGS' when 'SMALL' then 'Expense' "
                        "when 'PROMO' then 'OthIncome' when 'LARGE' then 'OthExpense' else 'Bank' end",
            "description": "p_name",
            "accountsearchdisplayname": "p_brand",
        }),
        "subsidiary": ("region", {"id": "cast(r_regionkey as bigint)", "name": "r_name"}),
        "location": ("nation", {"id": "cast(n_nationkey as bigint)", "name": "n_name"}),
        "classification": ("nation", {"id": "cast(n_nationkey as bigint)", "name": "'Class ' || n_name"}),
        "department": ("region", {"id": "cast(r_regionkey as bigint)", "name": "'Dept ' || r_name"}),
        "customer": ("customer", {"id": "c_custkey", "entityid": "c_name"}),
        "vendor": ("supplier", {"id": "s_suppkey", "entityid": "s_name"}),
        "item": ("part", {"id": "p_partkey", "itemid": "p_name"}),
        "accounting_period": ("orders", {
            "id": "distinct " + ym,
            "periodname": f"case when {ym} = 199606 then 'FY 1996' else {d.period('o_orderdate')} end",
        }),
        "account_key": ("part", {
            "nsaccount": "distinct cast(4000 + p_size as bigint)",
            "modelmappingdetail": "'Map ' || cast(p_size % 5 as string)",
            "sortorder": "p_size",
            "reporttype": "case when p_size < 25 then 'PL' else 'BS' end",
            "reportsection": "'Section ' || cast(p_size % 9 as string)",
        }),
    }


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; kept, so that its file's footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = _roles(SparkDialect())[name]
    first = next(iter(columns.values()))
    df = table(spark, sf_dir, source).selectExpr(
        *[f"{e.removeprefix('distinct ')} as `{c}`" for c, e in columns.items()]
    )
    return df.distinct() if first.startswith("distinct ") else df


def roles(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: role(spark, sf_dir, n) for n in names}


def role_cte(*names: str) -> str:
    """The same roles as DuckDB common table expressions named r_<role>."""
    all_roles = _roles(DuckDialect())
    parts = []
    for name in names:
        source, columns = all_roles[name]
        distinct = "distinct " if next(iter(columns.values())).startswith("distinct ") else ""
        select = ", ".join(f'{e.removeprefix("distinct ")} as "{c}"' for c, e in columns.items())
        parts.append(f"r_{name} as (select {distinct}{select} from {source})")
    return ",\n".join(parts)


def stay_calendar(spark: SparkSession) -> Calendar:
    return Calendar.between(spark, STAYS_FROM, STAYS_TO)


def rental_calendar(spark: SparkSession) -> Calendar:
    return Calendar.between(spark, RENTALS_FROM, RENTALS_TO)


def calendar_cte(first: date, last: date) -> str:
    return (
        "cal as (select cast(d as date) as calendar_date, cast(month(d) as integer) as month_number, "
        "cast(year(d) as integer) as year_number, strftime(d, '%B %Y') as month_year_name "
        f"from generate_series(timestamp '{first} 00:00:00', timestamp '{last} 00:00:00', interval 1 day) g(d))"
    )


STAY_CAL = calendar_cte(STAYS_FROM, STAYS_TO)
RENTAL_CAL = calendar_cte(RENTALS_FROM, RENTALS_TO)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which DuckDB and Spark results compare."""
    return df.select(
        *[F.col(f"`{n}`").cast("double").alias(n) if t.startswith("decimal") else F.col(f"`{n}`") for n, t in df.dtypes]
    )
