"""Reports of the operations and accounting side on the supplied tables."""

from __future__ import annotations

from quayside.plans import ledger, views
from quayside.sources.calendar import Calendar
from workload.roles import (
    RENTAL_CAL, STAY_CAL, plain, rental_calendar, role, role_cte, roles, stay_calendar,
)

KIND_OF = {  # document type by order priority and status, each order has exactly one
    "1F": "journal", "1O": "vendor_bill", "1P": "vendor_credit",
    "2F": "check", "2O": "deposit", "2P": "cash_sale",
    "3F": "invoice", "3O": "vendor_bill_payment", "3P": "customer_credit",
    "4F": "customer_payment", "4O": "customer_refund", "4P": "credit_card",
    "5F": "depreciation", "5O": "credit_card_refund", "5P": "journal",
}
DIMENSIONS = ("account", "subsidiary", "location", "classification", "department", "customer", "vendor", "item",
              "accounting_period", "account_key")


def boat_lengths(spark, sf):
    return plain(views.daily_boat_lengths(roles(spark, sf, "reservations", "boats", "marina_locations"), stay_calendar(spark)))


def slip_count(spark, sf):
    df = views.daily_slip_count(roles(spark, sf, "slips", "marina_locations"), stay_calendar(spark))
    return views.in_order(df, "daily_slip_count")


def slip_occupancy(spark, sf):
    t = roles(spark, sf, "slips", "reservations", "reservation_status", "marina_locations")
    return views.daily_slip_occupancy(t, stay_calendar(spark))


def rates(spark, sf):
    t = roles(spark, sf, "reservations", "reservation_status", "reservation_types", "slips", "marina_locations",
              "invoices", "invoice_items")
    return plain(views.reservation_rates(t, stay_calendar(spark)))


def rentals(spark, sf):
    t = roles(spark, sf, "booking_boats", "bookings", "style_boats")
    t["staged_booking_boats"] = t["booking_boats"]
    return plain(views.daily_rentals(t, rental_calendar(spark)))


def ledger_of(kind):
    def query(spark, sf):
        t = roles(spark, sf, "header", "line", "account")
        return plain(ledger.ledger_lines(t["header"], t["line"], t["account"], ledger.DOCUMENTS[kind]))

    return query


def finance(spark, sf):
    header, line = role(spark, sf, "header"), role(spark, sf, "line")
    books = {}
    for kind in ledger.DOCUMENTS:
        keys = [k for k, v in KIND_OF.items() if v == kind]
        books[kind] = (header.filter(header["kind"].isin(keys)), line)
    d = roles(spark, sf, *DIMENSIONS)
    return plain(ledger.finance_report(books, d))


def calendar_days(spark, sf):
    """The calendar over the whole span of the order dates."""
    from pyspark.sql import functions as F
    from workload.roles import table

    lo, hi = table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    return Calendar.between(spark, lo, hi).days


QUERIES = {
    "vw_daily_boat_lengths": boat_lengths,
    "vw_daily_slip_count": slip_count,
    "vw_daily_slip_occupancy": slip_occupancy,
    "vw_reservation_rates": rates,
    "vw_daily_rentals": rentals,
    "vw_finance_report": finance,
    "src_calendar": calendar_days,
    **{f"vw_ledger_{kind}": ledger_of(kind) for kind in ledger.DOCUMENTS},
}

def _days_of(rows: str, start: str, end: str, first: str = "(select min(calendar_date) from cal)",
             last: str = "(select max(calendar_date) from cal)") -> str:
    """Every row once per calendar day from `start` to `end`, both included."""
    return f"""select *, cast(unnest(generate_series(cast(greatest({start}, {first}) as timestamp), cast(least({end}, {last}) as timestamp),
  interval 1 day)) as date) as day from {rows} where {start} is not null and {end} is not null"""


# nights: the day of departure is not one
_NIGHTS = _days_of("(select *, cast(scheduled_arrival_time as date) as a, cast(scheduled_departure_time as date) - 1 as z from r_reservations)", "a", "z")

# Written from what each report says, by another way than the reports take: days are unnested from each stay, groups are
# formed on ids, and names are put to them afterwards.
ORACLE = {
    "src_calendar": """
select cast(d as date) as calendar_date, cast(month(d) as integer) as month_number,
       cast(year(d) as integer) as year_number, strftime(d, '%B %Y') as month_year_name
from (select unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day)) as d from orders)
""",
    "vw_daily_boat_lengths": f"""
with {role_cte("reservations", "boats", "marina_locations")}, {STAY_CAL},
nights as ({_NIGHTS}),
-- a boat that is not known is no boat
moored as (
  select day, (select x.id from r_boats x where x.id = n.boat_id) as boat, marina_location_id as marina, count(*) as stays,
    max(id) as last_stay, max(scheduled_arrival_time) as arrives, max(scheduled_departure_time) as leaves,
    coalesce(max(cast(reservation_status_id = 4 as integer)), 0) as inside
  from nights n group by all)
select cal.*, boat as boat_id, boats.name as boat_name, try_cast(regexp_extract(boats.loa, '^([^:]*):', 1) as double) as boat_loa_length,
  boats.make as boat_make, boats.model as boat_model, marina as marina_location_id, marinas.name as marina_location_name,
  last_stay as reservation_id, arrives as scheduled_arrival_time, leaves as scheduled_departure_time,
  coalesce(inside, 0) as occupies_slip
from moored full join cal on moored.day = cal.calendar_date
left join r_boats boats on boats.id = boat left join r_marina_locations marinas on marinas.id = marina
""",
    "vw_daily_slip_count": f"""
with {role_cte("slips", "marina_locations")}, {STAY_CAL},
open_days as ({_days_of("(select marina_location_id, cast(start_date as date) as a, coalesce(cast(end_date as date), date '9999-01-01') as z from r_slips where active = 1)", "a", "z")}),
counted as (select day, (select x.id from r_marina_locations x where x.id = o.marina_location_id) as marina, count(*) as n from open_days o group by all)
select cal.*, names.name as marina_name, marina as marina_id, n as daily_slip_count,
  case when contains(names.name, 'Mile High') then 8 when contains(names.name, 'Ray Roberts') then 16 else 0 end as subid
from counted join cal on day = calendar_date left join r_marina_locations names on names.id = marina
""",
    "vw_daily_slip_occupancy": f"""
with {role_cte("slips", "reservations", "reservation_status", "marina_locations")}, {STAY_CAL},
nights as ({_NIGHTS}),
berths as (
  select x.id as slip_id, x.name as slip_name, x.marina_location_id, y.name as marina_location_name
  from r_marina_locations y, r_slips x where x.marina_location_id = y.id and x.active = 1 and x.do_not_count_in_occupancy is null),
taken as (select n.* from nights n semi join berths on berths.slip_id = n.slip_id),
empty as (select slip_id, calendar_date as day from berths, cal except select slip_id, day from taken),
every as (select slip_id, day, id, scheduled_arrival_time, scheduled_departure_time, reservation_status_id, name from taken
  union all by name select * from empty)
select cal.*, berths.*, every.id as reservation_id, scheduled_arrival_time, scheduled_departure_time, reservation_status_id,
  (select min(k.name) from r_reservation_status k where k.id = every.reservation_status_id) as reservation_status_name,
  every.name as reservation_name, cast(coalesce(every.reservation_status_id in (4, 6), false) as integer) as is_occupied
from every join berths using (slip_id) join cal on day = calendar_date
""",
    "vw_reservation_rates": f"""
with {role_cte("reservations", "reservation_status", "reservation_types", "slips", "marina_locations", "invoices", "invoice_items")},
{STAY_CAL},
charges as (
  select reservation_id as payer, sum(x.total) as charged from r_invoice_items x join r_invoices y on x.invoice_id = y.id
  where x.is_void = 0 and x.status_field <> 'deleted' and x.type_field like 'charge-reservation-%'
    and substr(x.type_field, 20) in ('seasonal', 'transitive') group by payer),
-- a stay counts once for each marina in which its slip was ever booked
places as (select slip_id, count(distinct coalesce(marina_location_id, -1)) as times from r_reservations
  where slip_id in (select id from r_slips where active = 1 and do_not_count_in_occupancy is null) group by slip_id),
stays as (
  select r.*, times, cast(scheduled_arrival_time as date) as a, cast(scheduled_departure_time as date) as z,
    coalesce(charged, 0) as invoice_total
  from r_reservations r join places using (slip_id) left join charges on payer = r.id where reservation_status_id = 4),
-- months: whole ones between equal days of the month or two last days, else days and hours in 31sts
spans as (
  select *, z - a as days, 12 * (year(z) - year(a)) + month(z) - month(a) as turns,
    day(z) = day(a) or (z = last_day(z) and a = last_day(a)) as even,
    24 * (day(z) - day(a)) + hour(scheduled_departure_time) - hour(scheduled_arrival_time) as hours from stays),
units as (select *, turns + case when even then 0 else hours / 24.0 / 31.0 end as months from spans),
rated as (
  select u.*, round(months) as billed,
    case when days > 0 then [cast(rate as double) / days, cast(invoice_total as double) / days] else [0, 0] end as by_day,
    case when round(months) > 0 then [cast(rate as double) / round(months), cast(invoice_total as double) / months] else [0, 0] end as by_month
  from units u),
shown as (select *, list_transform(by_day || by_month, lambda x: cast(round(cast(x as decimal(28,10)), 2) as double)) as money from rated),
daily as ({_days_of("(select *, unnest(range(times)) as place from shown)", "a", "z")})
select cal.*, d.id as reservation_id, d.name as reservation_name, k.name as reservation_status, t.name as reservation_type,
  scheduled_arrival_time, scheduled_departure_time, cast(days as integer) as reservation_days,
  cast(round(cast(months as decimal(28,10)), 2) as double) as reservation_months, cast(invoice_total as double) as invoice_total,
  money[1] as reservation_daily_rate, money[2] as invoice_daily_rate, money[3] as reservation_monthly_rate, money[4] as invoice_monthly_rate
from daily d join cal on day = calendar_date left join r_reservation_status k on k.id = d.reservation_status_id
left join r_reservation_types t on t.id = d.reservation_type_id
""",
    "vw_daily_rentals": f"""
with {role_cte("booking_boats", "bookings", "style_boats")}, {RENTAL_CAL},
shares as (select booking_id, count(*) as boats from r_booking_boats group by booking_id),
finished as (
  select *, cast(boat_departure as date) as a, cast(boat_return as date) as z, epoch_us(boat_return) - epoch_us(boat_departure) as us
  from r_booking_boats where status_booking = 'Complete'),
touched as ({_days_of("finished", "a", "z")}),
priced as (
  select t.*, boat_number, cast(boats_total as double) as boats_total, boats, cast(us // 3600000000 as bigint) as hours
  from touched t join r_style_boats s on s.id = t.boat_id join shares using (booking_id)
  join r_bookings k on k.id = t.booking_id where k.is_canceled = 'No')
select cal.*, p.id as booking_boat_id, boat_id, boat_number, boat_departure, boat_return, booking_id, hours, boats_total,
  cast(round(cast(boats_total / boats as decimal(28,10)), 2) as double) as rate_per_boat,
  cast(round(cast(case when hours <> 0 then boats_total / (boats * hours) end as decimal(28,10)), 2) as double) as rate_per_boat_per_hour
from priced p join cal on day = calendar_date
""",
}

# Fixed values, as the reports of the fourteen document types state them: label; entity; whether items and quantities show
_LABELS = {
    "journal": ("journal", "entity", False), "vendor_bill": ("vendbill", "vendor", True), "vendor_credit": ("vendcred", "entity", True),
    "check": ("check", "entity", False), "deposit": ("deposit", None, False), "cash_sale": ("cashsale", "entity", True),
    "invoice": ("Invoice", "entity", True), "vendor_bill_payment": ("vendbillpayment", "vendor", False),
    "customer_credit": ("customercredit", "customer", False), "customer_payment": ("customerpayment", "customer", False),
    "customer_refund": ("customerrefund", "customer", False), "credit_card": ("creditcard", "entity", False),
    "depreciation": ("DEPENTRY", "entity", False), "credit_card_refund": ("ccrefund", "entity", False),
}


def _lines_sql(kind: str) -> str:
    """Posted lines of a type: lines with the account they are booked on, semi-joined to posted headers by USING."""
    label, entity, items = _LABELS[kind]
    foreign = kind == "depreciation"  # books the expense account, in foreign amounts, under the header's number
    money = "coalesce(creditforeignamount, 0) - coalesce(debitforeignamount, 0)" if foreign else (
        "coalesce(accountingbook_credit, 0) - coalesce(accountingbook_debit, 0)")
    return f"""
select '{label}' as t_type, tran_id, internalid, booked.id as line_id, tran_date, {"tran_id" if foreign else "trandisplayname"} as tran_name,
  subsidiary as subsidiary_id, location as location_id, class as division_id, department as department_id,
  cast({entity or -99999} as bigint) as entity_id, cast({"item" if items else -99999} as bigint) as item_id, posting_period_id,
  accounts.id as account_id, acctnumber as account_number, accttype as account_type, description as account_desc,
  cast({"-quantity" if items else "null"} as double) as qty, cast(null as double) as ext_cost, cast({money} as double) as acctg_amount, memo
from (select id, subsidiary, location, class, department, entity, vendor, customer, item, quantity, memo, trandisplayname, "transaction" as internalid,
        {"expenseaccount" if foreign else "account"} as booked_on, accountingbook_credit, accountingbook_debit, creditforeignamount,
        debitforeignamount from r_line) booked
join (select id as internalid, tranid as tran_id, trandate as tran_date, postingperiod as posting_period_id, kind from r_header
      where posting = 'T') heads using (internalid)
join r_account accounts on accounts.id = booked_on"""


for _kind in _LABELS:
    ORACLE[f"vw_ledger_{_kind}"] = f"with {role_cte('header', 'line', 'account')} {_lines_sql(_kind)}"


def _of(kind: str) -> str:
    return " where kind in (" + ", ".join(f"'{k}'" for k, v in KIND_OF.items() if v == kind) + ")"


def _if(*types: str) -> str:
    return "if(kinds.accttype in (" + ", ".join(f"'{t}'" for t in types) + "), acctg_amount, 0)"


ORACLE["vw_finance_report"] = f"""
with {role_cte("header", "line", *DIMENSIONS)},
booked as ({" union all ".join(_lines_sql(k) + _of(k) for k in _LABELS)}),
months as (select id, periodname, periodname[1:3] as m, periodname[5:] as y from r_accounting_period),
names(what, id, name) as (
  select 'subsidiary', id, name from r_subsidiary union all select 'location', id, name from r_location
  union all select 'class', id, name from r_classification union all select 'department', id, name from r_department
  union all select 'customer', id, entityid from r_customer union all select 'vendor', id, entityid from r_vendor
  union all select 'item', id, itemid from r_item)
select t_type, tran_id, internalid, line_id, tran_date, tran_name, n1.name as subsidiary, n2.name as location, n3.name as class,
  n4.name as department, n5.name as customer, n6.name as tran_vendor, n7.name as item_name, kinds.acctnumber as account_number,
  kinds.accttype as account_type, accountsearchdisplayname as account_desc, y[1:8] as posting_year, m as posting_month,
  cast(strftime(try_strptime(m || ' ' || y[1:8], '%b %Y'), '%Y%m') as integer) as posting_month_num, acctg_amount,
  {_if("Income")} as income_amount, {_if("COGS")} as cogs_amount, {_if("Expense")} as expense_amount,
  {_if("OthIncome")} as otherincome_amount, {_if("OthExpense")} as otherexpense_amount, {_if("Income", "COGS")} as gross_profit,
  {_if("Income", "COGS", "Expense", "OthIncome", "OthExpense")} as net_profit, memo, modelmappingdetail as mapvalue, sortorder,
  reporttype, reportsection
from booked join r_account kinds on kinds.id = account_id left join months on months.id = posting_period_id
left join names n1 on n1.what = 'subsidiary' and n1.id = subsidiary_id left join names n2 on n2.what = 'location' and n2.id = location_id
left join names n3 on n3.what = 'class' and n3.id = division_id left join names n4 on n4.what = 'department' and n4.id = department_id
left join names n5 on n5.what = 'customer' and n5.id = entity_id left join names n6 on n6.what = 'vendor' and n6.id = entity_id
left join names n7 on n7.what = 'item' and n7.id = item_id
left join r_account_key k on k.nsaccount = try_cast(booked.account_number as bigint)
"""
