"""Archive, CSV and dump readers, conversion and staging over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import staging as sg
from quayside.operators.store import Store
from quayside.plans.registry import all_tables, columns_from_header
from quayside.session import new_folder
from quayside.sources import archives as ar
from quayside.sources.csv_tables import by_header, read_csv
from quayside.sources.sql_dump import read_sql_dump
from workload.roles import plain, table
from workload.snapshots import as_csv, write_archives

DOCS = ["doc_id", "text", "lang", "source"]

# --- archives ---------------------------------------------------------------

_PATH = """'export/' || case event_type when 'error' then 'A' when 'click' then 'b' else 'c' end || cast(event_id as string) ||
 case event_type when 'click' then '.ZIP' when 'view' then '.zip' when 'error' then '-DATA.sql.gz' when 'purchase' then '-data.SQL.gz' else '.csv' end"""


def latest(spark, sf):
    """The newest object of each suffix in a listing made from the events (object times cut to the day, so ties occur)."""
    listing = table(spark, sf, "events").selectExpr(f"{_PATH} as path", "date_trunc('DAY', ts) as modificationTime", "event_id as length")
    zips = ar.latest_archive(listing, ".zip", ignore_case=True).withColumn("kind", F.lit("zip"))
    tars = ar.latest_archive(listing, "-DATA.sql.gz", ignore_case=False).withColumn("kind", F.lit("tar"))
    return zips.unionByName(tars).select("kind", "path", "length")


def _lines(spark, sf, folder):
    docs = as_csv(table(spark, sf, "documents").select(*DOCS), f"{folder}/documents.csv")
    customers = as_csv(table(spark, sf, "customer"), f"{folder}/customer.csv")
    unlisted = as_csv(table(spark, sf, "part"), f"{folder}/part.csv")
    return docs.unionByName(customers).unionByName(unlisted)


def _written(spark, sf, kind, junk=b"", header_only=None):
    folder = new_folder(spark, f"archives-{kind}")
    member_folder = "export" if kind == "zip" else "data"
    lines = _lines(spark, sf, member_folder)
    if header_only:  # a blank line is no record
        lines = lines.unionByName(lines.limit(1).select(
            F.lit(f"{member_folder}/{header_only}.csv").alias("member"), F.lit("id").alias("header"), F.lit("").alias("line")))
    write_archives(lines, folder, kind, junk=junk).write.format("noop").mode("overwrite").save()
    return ar.list_archives(spark, folder)


_WANTED = {"documents": DOCS + ["no_such_column"], "customer": ["c_acctbal", "C_Name", "c_custkey"]}


def _documents(records):
    docs = ar.one_table(records, "documents", _WANTED["documents"])
    return docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def zip_documents(spark, sf):
    return _documents(ar.zip_records(_written(spark, sf, "zip"), _WANTED))


def tar_documents(spark, sf):
    return _documents(ar.tar_records(_written(spark, sf, "tar"), _WANTED))


def zip_landed(spark, sf):
    """Unpack once, then read one table: columns by header name in the order asked for."""
    records = ar.land(ar.zip_records(_written(spark, sf, "zip"), _WANTED), new_folder(spark, "landing"))
    t = ar.one_table(records, "customer", _WANTED["customer"])
    return t.selectExpr("cast(c_custkey as bigint) as c_custkey", "C_Name as c_name", "cast(c_acctbal as double) as c_acctbal")


def member_counts(spark, sf):
    records = ar.rows_of(ar.zip_records(_written(spark, sf, "zip"), _WANTED))
    return records.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_records"))


def missing_members(spark, sf):
    """A member with nothing but its header is found; only tables without a member are missing."""
    wanted = {**_WANTED, "coupons": ["id"], "holidays": ["id"]}
    return ar.missing_tables(ar.tar_records(_written(spark, sf, "tar", header_only="coupons"), wanted), list(wanted))


def undecodable(spark, sf):
    """Every line carries a byte that is no UTF-8; it is dropped, the rest stays."""
    return _documents(ar.tar_records(_written(spark, sf, "tar", junk=b"\xff"), _WANTED, on_bad_utf8="drop"))


# --- CSV and dump -------------------------------------------------------------

def csv_by_header(spark, sf):
    folder = new_folder(spark, "csv")
    table(spark, sf, "documents").select("source", "text", "doc_id", "n_chars").write.option("header", True).option(
        "escape", '"').option("quoteAll", True).csv(folder)
    raw = read_csv(spark, folder)
    return by_header(raw, {"doc_id": "Doc_Id", "text": "TEXT", "missing": "Nowhere"}).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def csv_split(spark, sf):
    """Files whose texts hold line feeds and quotes, each read by many tasks."""
    folder = new_folder(spark, "csv")
    table(spark, sf, "documents").select("doc_id", F.concat(F.lit('"'), F.coalesce("text", F.lit("")), F.lit('"\n.')).alias("text"), "lang").write.option(
        "header", True).option("escape", '"').option("quoteAll", True).csv(folder)
    raw = read_csv(spark, folder, range_bytes=1 << 18)
    return raw.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def sql_dump(spark, sf):
    """Two rows per statement, with quotes, commas, parentheses and ends of statements in the text; read by many tasks."""
    folder = new_folder(spark, "dump")
    orders = table(spark, sf, "orders").select(F.concat(
        F.lit("INSERT INTO `orders` VALUES ("), F.col("o_orderkey").cast("string"), F.lit(",'O\\'Neil (no. "),
        F.col("o_custkey").cast("string"), F.lit(");\n-- back\\\\slash',"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit(",NULL),\n("),
        (-F.col("o_orderkey") - 1).cast("string"), F.lit(",NULL, x ,'"), F.col("o_orderpriority"), F.lit("')"),
    ).alias("value"))
    other = table(spark, sf, "nation").select(F.concat(
        F.lit("-- it's the next table\ninsert into `nation` values ("), F.col("n_nationkey").cast("string"), F.lit(")")).alias("value"))
    orders.unionByName(other).write.option("lineSep", ";\n").text(folder)
    return plain(read_sql_dump(spark, folder, "ORDERS", "id bigint, note string, price decimal(12,2), priority string", range_bytes=1 << 18))


# --- conversion and staging ----------------------------------------------------

def _num(c, k):
    return f"case when {k} % 17 = 3 then '' when {k} % 19 = 4 then ' ' || cast({c} as string) || ' ' else cast({c} as string) end"


_RESERVATIONS = {
    "Id": "cast(o_orderkey as string)",
    "Name": "case when o_orderkey % 13 = 0 then '  ' else '  Stay ' || cast(o_orderkey as string) end",
    "MarinaLocationId": _num("o_custkey % 25", "o_orderkey"),
    "ReservationStatusId": "case when o_orderkey % 101 = 7 then 'seven' else cast(o_orderkey % 7 as string) end",
    "SlipId": _num("o_custkey", "o_orderkey"),
    "Rate": "case when o_orderkey % 3 = 0 then '123.5' when o_orderkey % 3 = 1 then '-2.5' else cast(cast(o_totalprice as decimal(12,2)) as string) end",
    "ScheduledArrivalTime": "case when o_orderkey % 11 = 0 then '02/30/1997 00:00' else {us} end",
    "Unknown": "'ignored'",
}
_US = {"spark": "date_format(o_orderdate, 'MM/dd/yyyy HH:mm:ss')", "duck": "strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')"}


def _raw_reservations(spark, sf):
    return table(spark, sf, "orders").selectExpr(*[f"{e.format(us=_US['spark'])} as `{c}`" for c, e in _RESERVATIONS.items()])


def reservations(spark, sf):
    typed, _ = sg.convert_table(_raw_reservations(spark, sf), all_tables()["reservations"])
    return plain(typed)


def reservations_bad(spark, sf):
    _, bad = sg.convert_table(_raw_reservations(spark, sf), all_tables()["reservations"])
    return bad.select(F.array_join("_bad_columns", ",").alias("bad_columns"), F.get_json_object("_raw", "$.id").alias("id"))


def invoice_items(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(
        "cast(l_orderkey * 10 + l_linenumber as string) as Id",
        "case l_linenumber when 1 then 'N/A' when 2 then cast(l_orderkey as string) || '.0' else cast(l_orderkey as string) end as InvoiceId",
        "case l_returnflag when 'R' then 'NONE' else cast(cast(l_extendedprice as decimal(12,2)) as string) end as Total",
        "case l_returnflag when 'A' then ' charge-reservation-seasonal ' else 'NULL' end as Type",
        "case l_linestatus when 'F' then 'yes' else 'T' end as IsVoid", "l_returnflag as Status",
        "case when l_quantity > 25 then '' else 'Item' end as Title")
    return plain(sg.convert_table(raw, all_tables()["invoice_items"])[0])


def slips(spark, sf):
    raw = table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as string) as Id", "s_name as Name", "'30:' || cast(s_suppkey as string) as RecomendedLOA",
        "case when s_suppkey % 5 = 0 then '1.0' else cast(s_nationkey as string) end as MarinaLocationId",
        "'1/2/2024 3:04' as StartDate", "'soon' as EndDate", "case when s_suppkey % 3 = 0 then 't' else '' end as DoNotCountInOccupancy",
        "case when s_acctbal > 0 then 'TRUE' else 'n' end as Active")
    return sg.convert_table(raw, all_tables()["slips"])[0]


_RENTAL_TEXT = {
    "id": "cast(event_id as string)", "booking_id": "cast(event_id // 3 as string)",
    "boat_id": "case when event_id % 7 = 0 then 'BOAT-' || cast(user_id as string) when event_id % 7 = 1 then 'none' else cast(user_id as string) end",
    "boat_departure": "{ts}", "boat_return": "case when event_id % 5 = 0 then '' else {ts_min} end",
    "status": "case when event_id % 50 = 1 then repeat('x', 60) when event_type = 'error' then '' else event_type end",
    "checkin_notes": "event_type || ' at ' || {ts}",
}


def _rental_text(duck: bool) -> dict[str, str]:
    ts = "strftime(ts, '%Y-%m-%d %H:%M:%S')" if duck else "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"
    minutes = "strftime(ts, '%Y-%m-%d %H:%M')" if duck else "date_format(ts, 'yyyy-MM-dd HH:mm')"
    out = {c: e.format(ts=ts, ts_min=minutes) for c, e in _RENTAL_TEXT.items()}
    if not duck:
        out["booking_id"] = "cast(event_id div 3 as string)"
    return out


def _raw_booking_boats(spark, sf):
    return table(spark, sf, "events").selectExpr(*[f"{e} as `{c}`" for c, e in _rental_text(False).items()])


def booking_boats(spark, sf):
    return sg.convert_table(_raw_booking_boats(spark, sf), all_tables()["booking_boats"])[0]


def strict_dates(spark, sf):
    """Text dates that do not read set their row aside instead of failing the table."""
    raw = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) as id", "'100.005' as boats_total", "'No' as is_canceled", "o_orderpriority as notes",
        "case when o_orderkey % 10 = 3 then date_format(o_orderdate, 'MM/dd/yyyy') when o_orderkey % 10 = 4 then '' "
        "else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end as created_at")
    store = Store(spark, new_folder(spark, "strict"))
    sg.load_table(store, raw, all_tables()["bookings"])
    return plain(sg.staged(store, "bookings"))


def all_converted(spark, sf):
    """Each of the 79 tables converted from the customers' text; tables without a schema here take one from their header."""
    raw = table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) as Id", "c_name as Name", "cast(c_acctbal as string) as Balance",
        "cast(c_custkey as string) as user_id", "cast(c_custkey as string) as time_id",
        "cast(c_custkey as string) as location_id", "cast(c_custkey as string) as booking_id", "cast(c_custkey as string) as Contact_Id")
    out = None
    for name, spec in all_tables().items():
        if spec.schema is None:
            spec = spec.with_schema(columns_from_header(raw.columns))
        rows = sg.convert_rows(raw, spec)
        one = rows.agg(F.count_if(~F.col("_bad")).alias("n_rows"), F.sum(F.col(spec.keys[0])).cast("bigint").alias("key_sum"))
        one = one.select(F.lit(name).alias("table_name"), "n_rows", "key_sum")
        out = one if out is None else out.unionByName(one)
    return out


def unlisted_columns(spark, sf):
    """A load that fills three columns leaves the others of its staging table NULL."""
    spec = all_tables()["reservations"]
    typed, _ = sg.convert_table(_raw_reservations(spark, sf), spec.with_schema(spec.schema, loaded=("id", "name", "slip_id")))
    return plain(typed)


def replaced(spark, sf):
    """Two snapshots: the second stands, nothing of the first."""
    store = Store(spark, new_folder(spark, "staging"))
    orders = table(spark, sf, "orders")
    sg.stage(store, "orders", orders.select("o_orderkey", F.lit("old").alias("state")))
    sg.stage(store, "orders", orders.select((F.col("o_orderkey") + 1).alias("o_orderkey"), F.col("o_orderstatus").alias("state")))
    return sg.staged(store, "orders")


def _no_faults():
    return F.lit(0).cast("bigint").alias("bad_rows"), F.lit(None).cast("string").alias("columns_not_found")


def load_report(spark, sf):
    """Bad rows and columns without a header, table by table; a rental snapshot of bad rows only leaves the last one standing."""
    store = Store(spark, new_folder(spark, "staging"))
    specs = {n: all_tables()[n] for n in ("bookings", "style_boats", "slips")}
    orders = table(spark, sf, "orders")
    day = "case when o_orderpriority = '1-URGENT' then 'soon' else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end as created_at"
    raw = {
        "bookings": orders.selectExpr("cast(o_orderkey as string) as id", "'1.5' as boats_total", day),
        "style_boats": table(spark, sf, "customer").selectExpr("cast(c_custkey as string) as id"),
        "slips": table(spark, sf, "supplier").selectExpr("cast(s_suppkey as string) as Id", "s_name as Name", "'2' as MarinaLocationId"),
    }
    first = sg.load_all(store, raw, specs)
    worse = {"bookings": orders.selectExpr("cast(o_orderkey as string) as id", "'soon' as created_at")}
    second = sg.load_all(store, worse, {"bookings": specs["bookings"]})
    standing = sg.staged(store, "bookings").agg(F.count(F.lit(1)).alias("records")).select(
        F.lit("bookings").alias("table_name"), "records", *_no_faults(), F.lit("standing").alias("outcome"), F.lit(None).cast("string").alias("message"))
    return first.unionByName(second).unionByName(standing)


def expired(spark, sf):
    """Of five versions the last two stay, and so do the folders they name."""
    store = Store(spark, new_folder(spark, "versions"))
    for i in range(5):
        store.write("orders", table(spark, sf, "orders").filter(F.col("o_orderkey") % 5 == i).select("o_orderkey"))
    gone = store.expire("orders", keep=2)
    return store.read("orders").select("o_orderkey", F.lit(len(gone)).cast("bigint").alias("expired"), F.lit(
        len(store.files.names(f"{store.root}/orders"))).cast("bigint").alias("folders"))


def of_registry(name, columns):
    """A registry table loaded from text under the file's own headers: {header: (SQL, column, type)}."""
    def query(spark, sf):
        raw = table(spark, sf, "customer").selectExpr(*[f"{e} as `{h}`" for h, (e, _, _) in columns.items()])
        spec = all_tables()[name].with_schema(", ".join(f"{c} {t}" for _, c, t in columns.values()))
        return plain(sg.convert_table(raw, spec)[0])

    return query


_NO, _TEXT, _SUM = "cast(c_custkey as string)", "c_name", "cast(c_acctbal as string)"
_PRICE = "case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 then 'n/a' else '2.50' end"
_MAYBE = "case when c_custkey % 3 = 0 then '' else cast(c_nationkey as string) end"
_FLAG = "case c_custkey % 5 when 0 then '' when 1 then 'T' when 2 then 'F' when 3 then '1' else 'False' end"
# by table: header in the file -> its text here, the staging column it fills, that column's type
REGISTRY_TEXT = {
    "contacts": {"Id": (_NO, "id", "bigint"), "DateOfBirth": ("'02/03/1980'", "date_of_birth", "date")},
    "styles": {
        "id": (_NO, "id", "bigint"), "position": (_NO, "position_order", "bigint"), "image": (_TEXT, "image_url", "varchar(500)"),
        "length": (_SUM, "length_feet", "decimal(12,2)"), "width": (_SUM, "width_feet", "decimal(12,2)"),
        "draft": (_SUM, "draft_feet", "decimal(12,2)"), "description": (_TEXT, "description_text", "string"),
        "summary": (_TEXT, "summary_text", "string")},
    "club_tiers": {
        "id": (_NO, "id", "bigint"), "bdrd": (_SUM, "boat_damage_responsibility_deduction", "decimal(12,2)"),
        "description": (_TEXT, "description_text", "string"), "terms": (_TEXT, "terms_text", "string"), "status": (_TEXT, "status_tier", "varchar(50)")},
    "style_boats": {
        "id": (_NO, "id", "bigint"), "serial": (_TEXT, "serial_number", "varchar(191)"), "type": (_TEXT, "boat_type", "varchar(191)"),
        "position": (_NO, "position_order", "bigint"), "status": (_TEXT, "status_boat", "varchar(50)")},
    "seasonal_prices": {
        "Id": (_NO, "id", "bigint"), "SeasonName": (_TEXT, "season_name", "varchar(255)"), "PricePerFoot": (_PRICE, "price_per_foot", "decimal(9,2)")},
    "transient_prices": {
        "Id": (_NO, "id", "bigint"), "PricePerFoot": (_PRICE, "price_per_foot", "decimal(9,2)"), "MarinaLocationId": (_MAYBE, "marina_location_id", "bigint"),
        "IsActive": (_FLAG, "is_active", "int")},
    "invoices": {"Id": (_NO, "id", "bigint"), "InstalmentsPaymentMethodId": ("'3'", "installments_payment_method_id", "bigint")},
}


def replaced_all(spark, sf):
    """All marina staging is replaced at once: a table the second snapshot lacks ends up empty."""
    store = Store(spark, new_folder(spark, "staging"))
    specs = {n: all_tables()[n] for n in ("piers", "boat_types", "reservation_types")}
    piers = table(spark, sf, "supplier").selectExpr("cast(s_suppkey as string) as Id", "s_name as Name")
    types = table(spark, sf, "part").selectExpr("cast(p_partkey as string) as Id", "p_name as Name")
    sg.load_all(store, {"piers": piers, "boat_types": types}, specs)
    second = sg.load_all(store, {"piers": piers}, specs)
    for name in ("piers", "boat_types"):
        standing = sg.staged(store, name).agg(F.count(F.lit(1)).alias("records"))
        second = second.unionByName(standing.select(
            F.lit(name).alias("table_name"), "records", *_no_faults(), F.lit("standing").alias("outcome"), F.lit(None).cast("string").alias("message")))
    return second


def skipped(spark, sf):
    """Names of the members on no list."""
    rows = ar.skipped_members(_written(spark, sf, "zip"), ["documents", "customer"])
    return rows.select("table_name").distinct()


def only_if_filled(spark, sf):
    """A snapshot without rows leaves the last one standing and is reported."""
    store = Store(spark, new_folder(spark, "staging"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    first = sg.stage(store, "customer", customer, only_if_filled=True)
    empty = sg.stage(store, "customer", customer.filter("c_custkey < 0"), only_if_filled=True)
    kept = sg.staged(store, "customer").agg(F.count(F.lit(1)).alias("records")).select(
        F.lit("customer").alias("table_name"), "records", *_no_faults(), F.lit("standing").alias("outcome"), F.lit(None).cast("string").alias("message"))
    return first.unionByName(empty).unionByName(kept)


def partial_failure(spark, sf):
    """One table with unreadable dates, one absent from the archive: both are reported, the rest loads."""
    store = Store(spark, new_folder(spark, "staging"))
    specs = {n: all_tables()[n] for n in ("bookings", "style_boats", "holidays", "piers")}
    raw = {
        "bookings": table(spark, sf, "orders").selectExpr("cast(o_orderkey as string) as id", "o_orderpriority as created_at"),
        "style_boats": table(spark, sf, "customer").selectExpr("cast(c_custkey as string) as id", "c_name as boat_number"),
        "piers": table(spark, sf, "supplier").selectExpr("cast(s_suppkey as string) as Id", "s_name as Name"),
    }
    return sg.load_all(store, raw, specs, on_bad_rows="fail")


def versioned(spark, sf):
    store = Store(spark, new_folder(spark, "versions"))
    store.write("lineitem", table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))
    again = store.read("lineitem")  # read the version that is being replaced
    store.write("lineitem", again.select((F.col("l_orderkey") + 1).alias("l_orderkey"), "l_linenumber"))
    return store.read("lineitem").select("l_orderkey", "l_linenumber", F.lit(store.version("lineitem")).cast("bigint").alias("version"))


def warehouse_scan(spark, sf):
    """A filtered, two-column read of a warehouse table."""
    store = Store(spark, new_folder(spark, "scan"))
    store.write("orders", table(spark, sf, "orders"))
    return store.read("orders").filter("o_orderdate >= timestamp_ntz'1998-01-01 00:00:00' and o_orderstatus = 'F'").select("o_orderkey", "o_custkey")


QUERIES = {
    "src_warehouse_scan": warehouse_scan,
    "src_latest_archive": latest, "src_zip_members": zip_documents, "src_tar_members": tar_documents,
    "src_zip_landed": zip_landed, "src_member_counts": member_counts, "src_missing_members": missing_members,
    "src_undecodable_dropped": undecodable, "src_csv_by_header": csv_by_header, "src_csv_split": csv_split,
    "src_sql_dump": sql_dump,
    "cv_table_reservations": reservations, "cv_table_bad_rows": reservations_bad, "cv_table_invoice_items": invoice_items,
    "cv_table_slips": slips, "cv_table_booking_boats": booking_boats, "cv_table_all": all_converted,
    "src_skipped_members": skipped, "snk_replace_all": replaced_all, "snk_replace": replaced, "snk_replace_if_filled": only_if_filled, "snk_unlisted_columns": unlisted_columns,
    "snk_strict_dates": strict_dates, "snk_partial_failure": partial_failure, "snk_versioned_write": versioned,
    "snk_load_report": load_report, "snk_expire": expired,
    **{f"cv_table_{name}": of_registry(name, columns) for name, columns in REGISTRY_TEXT.items()},
}

_docs = "select doc_id, nullif(text, '') as text, lang, source, cast(null as varchar) as no_such_column from documents"
_raw = "select " + ", ".join(f'{e.format(us=_US["duck"])} as "{c}"' for c, e in _RESERVATIONS.items()) + " from orders"
_is_bad = "\"ReservationStatusId\" = 'seven'"
_typed = f"""select cast("Id" as bigint) as id, nullif(trim("Name"), '') as name, cast(nullif(trim("MarinaLocationId"), '') as bigint) as marina_location_id,
  cast("ReservationStatusId" as bigint) as reservation_status_id, cast(null as bigint) as reservation_type_id, cast(null as bigint) as boat_id,
  cast(nullif(trim("SlipId"), '') as bigint) as slip_id, try_strptime("ScheduledArrivalTime", '%m/%d/%Y %H:%M:%S') as scheduled_arrival_time,
  cast(null as timestamp) as scheduled_departure_time, cast(cast(cast("Rate" as decimal(12,2)) as decimal(10,0)) as double) as rate
from ({_raw}) r where not ({_is_bad})"""
_boats_raw = "select " + ", ".join(f'{e} as "{c}"' for c, e in _rental_text(True).items()) + " from events"


# The names of the 79 tables.
_ALL_TABLES = (
    "marina_locations", "piers", "slip_types", "slips", "reservations", "companies", "contacts", "boats", "accounts", "invoices",
    "invoice_items", "transactions", "item_masters", "seasonal_prices", "transient_prices", "record_status", "boat_types",
    "power_needs", "reservation_status", "reservation_types", "contact_types", "invoice_status", "invoice_types",
    "transaction_types", "transaction_methods", "insurance", "equipment", "account_status", "contact_auto_charge",
    "statements_preference", "invoice_item_types", "payment_methods", "seasonal_charge_methods", "seasonal_invoicing_methods",
    "transient_charge_methods", "transient_invoicing_methods", "recurring_invoice_options", "due_date_settings",
    "item_charge_methods", "insurance_status", "equipment_types", "equipment_fuel_types", "vessel_engine_class", "cities",
    "countries", "currencies", "phone_types", "address_types", "installments_payment_methods", "payments_provider",
    "customers", "locations", "seasons", "accessories", "accessory_options", "accessory_tiers", "amenities", "categories",
    "holidays", "bookings", "booking_boats", "booking_payments", "booking_accessories", "style_groups", "styles", "style_boats",
    "customer_boats", "season_dates", "style_hourly_prices", "style_times", "style_prices", "club_tiers", "coupons", "pos_items",
    "pos_sales", "fuel_sales", "waitlists", "closed_dates", "blacklists",
)


def _all_sql() -> str:
    return " union all ".join(
        f"select '{n}' as table_name, count(*) as n_rows, cast(sum(c_custkey) as bigint) as key_sum from customer" for n in _ALL_TABLES)


ORACLE = {
    "src_warehouse_scan": "select o_orderkey, o_custkey from orders where o_orderdate >= timestamp '1998-01-01' and o_orderstatus = 'F'",
    "src_latest_archive": f"""
with l as (select {_PATH} as path, date_trunc('day', ts) as t, event_id as length from events)
select * from (select 'zip' as kind, path, length from l where lower(path) like '%.zip' order by t desc, path limit 1)
union all select * from (select 'tar', path, length from l where path like '%-DATA.sql.gz' order by t desc, path limit 1)""",
    "src_zip_members": _docs,
    "src_tar_members": _docs,
    "src_undecodable_dropped": _docs,
    "src_zip_landed": "select c_custkey, c_name, c_acctbal from customer",
    "src_member_counts": "select 'documents' as table_name, count(*) as n_records from documents union all select 'customer', count(*) from customer",
    "src_missing_members": """
select t as table_name from (select unnest(['documents', 'customer', 'holidays']) as t)
where t not in (select 'documents' from documents union all select 'customer' from customer)""",
    "src_csv_by_header": "select doc_id, nullif(text, '') as text, cast(null as varchar) as missing from documents",
    "src_csv_split": "select doc_id, '\"' || coalesce(text, '') || '\"' || chr(10) || '.' as text, lang from documents",
    "src_sql_dump": """
select o_orderkey as id, 'O''Neil (no. ' || cast(o_custkey as varchar) || ');' || chr(10) || '-- back\\slash' as note,
  cast(cast(o_totalprice as decimal(12,2)) as double) as price, null as priority from orders
union all select -o_orderkey - 1, null, null, o_orderpriority from orders""",
    "cv_table_reservations": _typed,
    "cv_table_bad_rows": f"select 'reservation_status_id' as bad_columns, \"Id\" as id from ({_raw}) r where {_is_bad}",
    "cv_table_invoice_items": """
select l_orderkey * 10 + l_linenumber as id, case l_linenumber when 1 then 0 else l_orderkey end as invoice_id,
  case l_returnflag when 'R' then 0 else cast(cast(l_extendedprice as decimal(9,2)) as double) end as total,
  case l_returnflag when 'A' then 'charge-reservation-seasonal' end as type_field,
  case l_linestatus when 'F' then 1 else 0 end as is_void, l_returnflag as status_field,
  case when l_quantity > 25 then 'Untitled Item' else 'Item' end as title from lineitem""",
    "cv_table_slips": """
select s_suppkey as id, s_name as name, '30:' || cast(s_suppkey as varchar) as recommended_loa,
  case when s_suppkey % 5 = 0 then null else cast(s_nationkey as bigint) end as marina_location_id,
  timestamp '2024-01-02 03:04:00' as start_date, cast(null as timestamp) as end_date,
  case when s_suppkey % 3 = 0 then 1 end as do_not_count_in_occupancy, case when s_acctbal > 0 then 1 else 0 end as active from supplier""",
    "cv_table_booking_boats": f"""
select cast(id as bigint) as id, cast(booking_id as bigint) as booking_id,
  coalesce(cast(nullif(regexp_replace(boat_id, '[^0-9]', '', 'g'), '') as bigint), 0) as boat_id,
  cast(boat_departure as timestamp) as boat_departure, cast(nullif(boat_return, '') as timestamp) as boat_return,
  nullif(status, '') as status_booking, checkin_notes from ({_boats_raw}) r where length(status) <= 50""",
    "cv_table_all": _all_sql(),
    "snk_replace": "select o_orderkey + 1 as o_orderkey, o_orderstatus as state from orders",
    "src_skipped_members": "select 'part' as table_name from part limit 1",
    "snk_replace_all": """
select 'piers' as table_name, count(*) as records, 0 as bad_rows, 'marina_location_id' as columns_not_found, 'replaced' as outcome, null as message from supplier
union all select 'boat_types', 0, 0, null, 'emptied', 'file not in archive'
union all select 'reservation_types', 0, 0, null, 'emptied', 'file not in archive'
union all select 'piers', count(*), 0, null, 'standing', null from supplier
union all select 'boat_types', 0, 0, null, 'standing', null""",
    "snk_replace_if_filled": """
select 'customer' as table_name, count(*) as records, 0 as bad_rows, null as columns_not_found, 'replaced' as outcome, null as message from customer
union all select 'customer', 0, 0, null, 'left as it was', 'No data rows in CSV file'
union all select 'customer', count(*), 0, null, 'standing', null from customer""",
    "snk_unlisted_columns": f"""select id, name, null as marina_location_id, null as reservation_status_id, null as reservation_type_id, null as boat_id,
  slip_id, null as scheduled_arrival_time, null as scheduled_departure_time, null as rate
from ({_typed.replace(f'where not ({_is_bad})', '').replace('cast("ReservationStatusId" as bigint)', 'null')}) t""",
    "snk_strict_dates": """
select o_orderkey as id, 100.01 as boats_total, 'No' as is_canceled, o_orderpriority as notes,
  case when o_orderkey % 10 = 4 then null else o_orderdate end as created_at from orders where o_orderkey % 10 <> 3""",
    "snk_partial_failure": """
select 'bookings' as table_name, 0 as records, null as bad_rows, null as columns_not_found, 'failed' as outcome,
  'bookings: unreadable text in [''created_at'']' as message
union all select 'style_boats', count(*), 0, null, 'replaced', null from customer
union all select 'holidays', 0, 0, null, 'failed', 'file not in archive'
union all select 'piers', count(*), 0, 'marina_location_id', 'replaced', null from supplier""",
    "snk_load_report": """
with read as (select count(*) filter (where o_orderpriority <> '1-URGENT') as good, count(*) as n from orders)
select 'bookings' as table_name, good as records, n - good as bad_rows, 'is_canceled, notes' as columns_not_found, 'replaced' as outcome,
  null as message from read
union all select 'style_boats', count(*), 0, 'boat_number', 'replaced', null from customer
union all select 'slips', count(*), 0, 'recommended_loa, start_date, end_date, do_not_count_in_occupancy, active', 'replaced', null from supplier
union all select 'bookings', 0, n, 'boats_total, is_canceled, notes', 'left as it was',
  'no row could be loaded: unreadable text in [''created_at'']' from read
union all select 'bookings', good, 0, null, 'standing', null from read""",
    "snk_expire": "select o_orderkey, 3 as expired, 2 as folders from orders where o_orderkey % 5 = 4",
    "cv_table_contacts": "select c_custkey as id, date '1980-02-03' as date_of_birth from customer",
    "cv_table_styles": """
select c_custkey as id, c_custkey as position_order, c_name as image_url, cast(c_acctbal as double) as length_feet,
  cast(c_acctbal as double) as width_feet, cast(c_acctbal as double) as draft_feet, c_name as description_text, c_name as summary_text from customer""",
    "cv_table_club_tiers": """
select c_custkey as id, cast(c_acctbal as double) as boat_damage_responsibility_deduction, c_name as description_text,
  c_name as terms_text, c_name as status_tier from customer""",
    "cv_table_style_boats": """
select c_custkey as id, c_name as serial_number, c_name as boat_type, c_custkey as position_order, c_name as status_boat from customer""",
    "cv_table_seasonal_prices": """
select c_custkey as id, c_name as season_name, cast(case when c_custkey % 3 = 2 then 2.5 else 0 end as double) as price_per_foot from customer""",
    "cv_table_transient_prices": """
select c_custkey as id, cast(case when c_custkey % 3 = 2 then 2.5 else 0 end as double) as price_per_foot,
  case when c_custkey % 3 <> 0 then c_nationkey end as marina_location_id,
  case c_custkey % 5 when 1 then 1 when 2 then 0 when 3 then 1 when 4 then 0 end as is_active from customer""",
    "cv_table_invoices": "select c_custkey as id, 3 as installments_payment_method_id from customer",
    "snk_versioned_write": "select l_orderkey + 1 as l_orderkey, l_linenumber, 2 as version from lineitem",
}
