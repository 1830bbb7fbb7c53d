"""The tables of both source systems and how their columns convert and merge.

A table needs three things: its row here (source file, family, merge flags),
its staging schema, and header names. Schemas are a parameter: pass the staging
table's StructType or DDL to `TableSpec.with_schema`, or all CREATE TABLE text
of an existing staging database to `with_database_ddl`. The tables the reports
read come with theirs below, the (id, name) code tables share one, and for any
other `columns_from_header` derives one from the file's own header. Converters
and merge parameters follow from the schema by rule.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructType, VarcharType,
)

from quayside.functions import convert as cv
from quayside.operators.merge import MergeSpec

MARINA, RENTAL = "marina", "rental"

# Source file -> table, system MARINA.
MARINA_FILES = {
    "MarinaLocations": "marina_locations", "Piers": "piers", "SlipTypes": "slip_types", "Slips": "slips",
    "Reservations": "reservations", "Companies": "companies", "Contacts": "contacts", "Boats": "boats",
    "Accounts": "accounts", "InvoiceSet": "invoices", "InvoiceItemSet": "invoice_items", "Transactions": "transactions",
    "ItemMasters": "item_masters", "SeasonalPrices": "seasonal_prices", "TransientPrices": "transient_prices",
    "RecordStatusSet": "record_status", "BoatTypes": "boat_types", "PowerNeeds": "power_needs",
    "ReservationStatus": "reservation_status", "ReservationTypes": "reservation_types", "ContactTypes": "contact_types",
    "InvoiceStatusSet": "invoice_status", "InvoiceTypeSet": "invoice_types", "TransactionTypeSet": "transaction_types",
    "TransactionMethodSet": "transaction_methods", "InsuranceSet": "insurance", "EquipmentSet": "equipment",
    "AccountStatus": "account_status", "ContactAutoChargeSet": "contact_auto_charge",
    "StatementsPreferenceSet": "statements_preference", "InvoiceItemTypeSet": "invoice_item_types",
    "PaymentMethods": "payment_methods", "SeasonalChargeMethods": "seasonal_charge_methods",
    "SeasonalInvoicingMethodSet": "seasonal_invoicing_methods", "TransientChargeMethods": "transient_charge_methods",
    "TransientInvoicingMethodSet": "transient_invoicing_methods",
    "RecurringInvoiceOptionsSet": "recurring_invoice_options", "DueDateSettingsSet": "due_date_settings",
    "ItemChargeMethods": "item_charge_methods", "InsuranceStatusSet": "insurance_status",
    "EquipmentTypeSet": "equipment_types", "EquipmentFuelTypeSet": "equipment_fuel_types",
    "VesselEngineClassSet": "vessel_engine_class", "Cities": "cities", "Countries": "countries",
    "CurrenciesSet": "currencies", "PhoneTypes": "phone_types", "AddressTypeSet": "address_types",
    "InstalmentsPaymentMethodSet": "installments_payment_methods", "PaymentsProviderSet": "payments_provider",
}
# Tables of system RENTAL, each in data/<table>.csv.
RENTAL_TABLES = (
    "customers", "locations", "seasons", "accessories", "accessory_options", "accessory_tiers", "amenities",
    "categories", "holidays", "bookings", "booking_boats", "booking_payments", "booking_accessories", "style_groups",
    "styles", "style_boats", "customer_boats", "season_dates", "style_hourly_prices", "style_times", "style_prices",
    "club_tiers", "coupons", "pos_items", "pos_sales", "fuel_sales", "waitlists", "closed_dates", "blacklists",
)

# Tables whose merge updates a match only when a compared column differs.
CHANGE_TESTED = {
    "piers", "slips", "reservations", "contacts", "boats", "accounts", "invoices", "invoice_items", "transactions",
    "account_status", "invoice_item_types", "seasonal_invoicing_methods", "transient_invoicing_methods",
    "recurring_invoice_options", "due_date_settings", "equipment_types", "equipment_fuel_types",
    "vessel_engine_class", "currencies", "address_types", "installments_payment_methods", "payments_provider",
    "customers", "bookings", "booking_boats", "booking_payments", "styles", "style_boats", "style_hourly_prices",
    "style_times", "style_prices", "pos_items", "pos_sales",
}
# Tables merged as soon as they are loaded.
AT_ONCE = {
    "piers", "slips", "reservations", "contacts", "boats", "invoices", "invoice_items", "transactions", "customers",
    "bookings", "booking_boats", "booking_payments", "styles", "style_boats", "style_hourly_prices", "style_times",
    "style_prices", "pos_items", "pos_sales",
}
# Business keys other than id; the last two are the documented composite keys.
KEYS = {
    "customers": ("user_id",), "style_prices": ("time_id",), "holidays": ("location_id", "holiday_date"),
    "booking_accessories": ("booking_id", "accessory_id"),
}
# Converter family of a MARINA table; all others are "plain".
FAMILY = {
    "slips": "typed", "seasonal_prices": "typed", "contacts": "person", "invoices": "defaulted", "invoice_items": "defaulted",
    "item_masters": "catalog", "transient_prices": "prices", "marina_locations": "worded", "transactions": "transaction",
}
# Defaults of required names.
TEXT_DEFAULTS = {
    ("marina_locations", "name"): "Unknown", ("item_masters", "name"): "Unknown Item",
    ("invoices", "title"): "Untitled Invoice", ("invoice_items", "title"): "Untitled Item",
}
# 1/other columns kept as Yes/No.
YES_NO = {
    ("accessories", "tax_exempt"), ("accessories", "use_striped_background"),
    ("accessory_options", "use_striped_background"), ("amenities", "frontend_display"), ("amenities", "featured"),
    ("amenities", "filterable"), ("categories", "frontend_display"), ("categories", "filter_unit_type_enabled"),
}
# Dates in staging that are time stamps in the warehouse.
STAMPED_DATES = {
    ("boats", "registration_expiration"), ("equipment", "creation_date"), ("invoice_items", "created_date"),
    ("reservations", "original_end_date"),
}
# Headers that are not the column name in another notation, by table.
HEADER_NAMES = {
    "slips": {"recommended_loa": "RecomendedLOA", "recommended_beam": "RecomendedBeam", "recommended_draft": "RecomendedDraft",
              "recommended_air_draft": "RecomendedAirDraft"},
    "invoices": {"date_field": "Date", "dollar_discount": "DolarDiscount", "installments_payment_method_id": "InstalmentsPaymentMethodId"},
    "invoice_items": {"type_field": "Type", "value_field": "Value", "date_field": "Date", "status_field": "Status"},
    "transactions": {"value_field": "Value"},
    "customers": {"date_of_birth": "dob", "boat_damage_responsibility_coverage": "bdrc"},
    "seasons": {"status_season": "status"},
    "accessories": {"position_order": "position", "image_url": "image"},
    "accessory_options": {"value_text": "value"},
    "amenities": {"amenity_type": "type", "options_text": "options", "prefix_text": "prefix", "suffix_text": "suffix",
                  "description_text": "description"},
    "categories": {"description_text": "description"},
    "bookings": {"insurance_amount": "insurance"},
    "booking_boats": {"status_booking": "status", "additional_drivers": "addl_drivers", "additional_driver_names": "addl_driver_names",
                      "date_of_birth": "dob"},
    "booking_payments": {"status_payment": "status"},
    "styles": {"position_order": "position", "image_url": "image", "length_feet": "length", "width_feet": "width", "draft_feet": "draft",
               "description_text": "description", "summary_text": "summary"},
    "style_boats": {"serial_number": "serial", "boat_type": "type", "position_order": "position", "status_boat": "status"},
    "customer_boats": {"length_feet": "length", "width_feet": "width"},
    "style_times": {"description_text": "description"},
    "club_tiers": {"boat_damage_responsibility_deduction": "bdrd", "description_text": "description", "terms_text": "terms",
                   "status_tier": "status"},
    "coupons": {"status_coupon": "status"},
    "waitlists": {"departure_date": "departure", "length_requested": "length"},
}
# Columns the load fills, whatever more the staging table and the file hold; other tables fill all.
LOADED = {
    "marina_locations": (
        "id", "name", "primary_phone_number", "primary_fax_number", "organization_id", "marina_hash", "unit_system",
        "default_arrival_time", "default_departure_time", "email_address", "marina_website", "time_zone"),
    "reservations": (
        "id", "marina_location_id", "creation_time", "reservation_status_id", "reservation_type_id", "contact_id", "boat_id",
        "scheduled_arrival_time", "scheduled_departure_time", "cancellation_time", "account_id", "slip_id", "rate", "name", "hash_id",
        "reservation_source"),
}
# Columns of other tables that the load leaves NULL.
NOT_LOADED = {
    "slips": ("max_revenue", "transient_price_id", "seasonal_price_id"),
    "invoices": ("hash_check",),
    "seasonal_prices": (
        "sv_inventory_category_id", "sv_inventory_sub_category_id", "deletion_datetime", "deletion_aspnet_user_id", "record_status_id",
        "deferred_revenue_recognition", "deferred_recognition_gl_code", "tracking_code", "xero_recognition_account_id",
        "revenue_xero_account_id", "allow_posting_to_non_income_accounts"),
    "cities": ("state", "country"),
    "countries": ("code",),
    "blacklists": ("updated_at",),
}

CODE_TABLE = "id bigint, name varchar(1000) not null"
# Schemas of the tables the reports read, cut to the columns they use.
# A string without length is a long note: loaded, updated, but not compared.
SCHEMAS = {
    "piers": "id bigint, name varchar(255), marina_location_id bigint",
    "accounts": "id bigint, account_status_id bigint, marina_location_id bigint, contact_id bigint not null",
    "marina_locations": "id bigint, name varchar(255), time_zone varchar(100)",
    "slips": "id bigint, name varchar(255), recommended_loa varchar(50), marina_location_id bigint, "
             "start_date timestamp_ntz, end_date timestamp_ntz, do_not_count_in_occupancy int, active int",
    "reservations": "id bigint, name varchar(500), marina_location_id bigint, reservation_status_id bigint, "
                    "reservation_type_id bigint, boat_id bigint, slip_id bigint, scheduled_arrival_time timestamp_ntz, "
                    "scheduled_departure_time timestamp_ntz, rate decimal(10,0)",
    "boats": "id bigint, name varchar(255), loa varchar(50), make varchar(255), model varchar(255)",
    "invoices": "id bigint, reservation_id bigint, total decimal(9,2), title varchar(500)",
    "invoice_items": "id bigint, invoice_id bigint, total decimal(9,2), type_field varchar(100), is_void int, "
                     "status_field varchar(1000), title varchar(500)",
    "bookings": "id bigint, boats_total decimal(10,2), is_canceled varchar(3), notes string, created_at timestamp_ntz",
    "booking_boats": "id bigint, booking_id bigint, boat_id bigint, boat_departure timestamp_ntz, "
                     "boat_return timestamp_ntz, status_booking varchar(50), checkin_notes string",
    "style_boats": "id bigint, boat_number varchar(191)",
    "customers": "user_id bigint, first_name varchar(191), last_name varchar(191), balance decimal(10,2), notes string, "
                 "created_at timestamp_ntz",
    "holidays": "location_id bigint, holiday_date date",
    "booking_accessories": "booking_id bigint, accessory_id bigint, qty bigint, price decimal(10,2)",
}
_WIDE = {"companies", "contacts", "transactions", "item_masters", "seasonal_prices", "transient_prices", "insurance",
         "equipment", "currencies"}

Converter = Callable[[Column], Column]


def _kind(t: DataType) -> str:
    if isinstance(t, (StringType, VarcharType)):
        return "text"
    if isinstance(t, DateType):
        return "day"
    if isinstance(t, IntegerType):
        return "flag"
    if isinstance(t, LongType):
        return "whole"
    return "number" if isinstance(t, (DecimalType, DoubleType)) else "stamp"


# family -> value kind -> (converter, strict). Text that a strict one turns down makes the row a bad row.
_LOADED = {
    "whole": (lambda c: cv.loaded(c, "decimal(20,0)"), True), "number": (lambda c: cv.loaded(c, "decimal(38,10)"), True),
    "flag": (cv.flag, False), "stamp": (cv.stamp, False), "day": (cv.day, False), "text": (cv.text, False),
}
_DEFAULTED = {"whole": (cv.whole_or, False), "number": (cv.number_or, False), "flag": (cv.flag_or, False),
              "stamp": (cv.trimmed_stamp, False), "day": (cv.day, False), "text": (cv.worded_text, False)}
FAMILIES: dict[str, dict[str, tuple[Converter, bool]]] = {
    "plain": _LOADED,
    "worded": {**_LOADED, "text": (cv.worded_text, False)},
    "typed": {**_LOADED, "whole": (cv.whole, False), "number": (cv.number_or_zero, False)},
    "defaulted": _DEFAULTED,
    "person": {**_DEFAULTED, "stamp": (cv.person_stamp, False), "day": (cv.person_day, False)},
    "catalog": {**_DEFAULTED, "stamp": (cv.iso_stamp, False)},
    "prices": {"whole": (cv.whole, False), "number": (cv.number_or_zero, False), "flag": (cv.flag, False),
               "stamp": (partial(cv.iso_stamp, words=("", "NULL")), False), "day": (cv.day, False), "text": (cv.text, False)},
    "transaction": {"whole": (cv.tx_whole, False), "number": (cv.tx_number, False), "flag": (cv.tx_flag, False),
                    "stamp": (cv.trimmed_stamp, False), "day": (cv.day, False), "text": (cv.text, False)},
    "rental": {"whole": (cv.whole, False), "number": (cv.number, False), "flag": (cv.whole, False),
               "stamp": (cv.rental_stamp, True), "day": (cv.rental_day, True), "text": (cv.as_is, True)},
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    header: str
    type: DataType
    convert: Converter
    strict: bool = False  # unreadable or over-long text makes a bad row
    length: int | None = None
    required: bool = False  # NULL makes a bad row


@dataclass(frozen=True)
class TableSpec:
    system: str
    source: str  # base name of the CSV member
    name: str
    family: str
    keys: tuple[str, ...]
    change_test: bool
    at_once: bool
    schema: StructType | None = None
    loaded: tuple[str, ...] | None = None  # columns the load fills; None: by LOADED and NOT_LOADED

    def with_schema(self, schema: StructType | str, loaded: tuple[str, ...] | None = None) -> "TableSpec":
        return replace(self, schema=_parsed(schema), loaded=loaded)

    @property
    def columns(self) -> list[ColumnSpec]:
        if self.schema is None:
            raise ValueError(f"{self.name}: no staging schema; give one with with_schema()")
        return [replace(_column(self, f.name, f.dataType), required=not f.nullable) for f in self.schema]

    @property
    def loaded_columns(self) -> list[ColumnSpec]:
        filled = self.loaded if self.loaded is not None else LOADED.get(self.name)
        if filled is not None:
            return [c for c in self.columns if c.name in filled]
        return [c for c in self.columns if c.name not in NOT_LOADED.get(self.name, ())]

    def for_warehouse(self, staged: DataFrame) -> DataFrame:
        """Staged rows in the types of the warehouse table."""
        stamps = {c: F.col(c).cast("timestamp_ntz") for c in staged.columns if (self.name, c) in STAMPED_DATES}
        return staged.withColumns(stamps) if stamps else staged

    @property
    def merge(self) -> MergeSpec:
        names = tuple(f.name for f in self.schema)
        compared = tuple(f.name for f in self.schema if not _long_text(f.dataType))
        return MergeSpec(self.keys, names, compared if self.change_test else None)


def _parsed(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _long_text(t: DataType) -> bool:
    return isinstance(t, StringType) and not isinstance(t, VarcharType)


def _column(spec: TableSpec, name: str, dtype: DataType) -> ColumnSpec:
    kind = _kind(dtype)
    convert, strict = FAMILIES[spec.family][kind]
    length = dtype.length if isinstance(dtype, VarcharType) else None
    place = (spec.name, name)
    if name in spec.keys and kind == "whole" and spec.family != "rental" and spec.name != "invoice_items":
        convert, strict = _LOADED["whole"]  # keys have no default
    if place in TEXT_DEFAULTS:
        convert = partial(cv.text_or, default=TEXT_DEFAULTS[place], length=length)
    elif place in YES_NO:
        convert = cv.yes_no
    elif place == ("booking_boats", "boat_id"):
        convert = cv.boat_number
    elif place[0] == "booking_boats" and kind == "stamp":
        convert, strict = partial(cv.rental_stamp, minutes=True), False
    elif kind == "text" and length and not strict:
        convert = partial(convert, length=length)
    return ColumnSpec(name, HEADER_NAMES.get(spec.name, {}).get(name, name), dtype, convert, strict, length)


def _spec(system: str, source: str, name: str) -> TableSpec:
    family = "rental" if system == RENTAL else FAMILY.get(name, "plain")
    ddl = SCHEMAS.get(name) or (CODE_TABLE if system == MARINA and name not in _WIDE else None)
    return TableSpec(system, source, name, family, KEYS.get(name, ("id",)), name in CHANGE_TESTED, name in AT_ONCE,
                     _parsed(ddl) if ddl else None)


def all_tables() -> dict[str, TableSpec]:
    """Every table of both systems, in load order."""
    marina = [_spec(MARINA, source, name) for source, name in MARINA_FILES.items()]
    rental = [_spec(RENTAL, name, name) for name in RENTAL_TABLES]
    return {s.name: s for s in marina + rental}


_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])|[^A-Za-z0-9]+")
_ENDINGS = (
    (r"(^|_)id$", "bigint"),
    (r"(^|_)(date|time|at|on)$|date_time$|^date_", "timestamp_ntz"),
    (r"^(is|has|allow|active|opened|taxable|do_not)(_|$)|_(done|exempt|enabled)$", "int"),
    (r"(price|total|amount|fee|fees|rate|percent|discount|balance|deposit|paid|quantity|tax|credit|hours|gallons)$", "double"),
)


def column_name(header: str) -> str:
    """MarinaLocationId, Pier_Id and pier_id in snake case."""
    return "_".join(p for p in _CAMEL.sub(" ", header).lower().split())


def columns_from_header(headers: list[str]) -> StructType:
    """A staging schema by naming rule: the ending of a column name tells its type, all else is text."""
    ddl = []
    for name in map(column_name, headers):
        dtype = next((t for pattern, t in _ENDINGS if re.search(pattern, name)), "varchar(1000)")
        ddl.append(f"`{name}` {dtype}")
    return StructType.fromDDL(", ".join(ddl))


_CREATE = re.compile(r"create\s+table\s+[\w.\"]*?(?:stg_[a-z]+_)?(\w+)\"?\s*\(\s*\n(.*?)^\s*\)", re.I | re.S | re.M)
_DDL_COLUMN = re.compile(r"^\s*\"?(\w+)\"?\s+(number|n?varchar2|n?char|n?clob|binary_double|date|timestamp)\b\s*(?:\(([^)]*)\))?([^\n]*)", re.I)


def database_type(name: str, size: str | None) -> str:
    """Spark type of a column type of the staging database."""
    name, numbers = name.lower(), [int(n) for n in re.findall(r"\d+", size or "")]
    if name == "number":
        digits, decimals = (numbers + [0, 0])[:2] if numbers else (38, 10)
        if decimals:
            return f"decimal({digits},{decimals})"
        return "int" if digits == 1 else "bigint" if digits <= 18 else f"decimal({digits},0)"
    if name in ("date", "binary_double"):
        return {"date": "date", "binary_double": "double"}[name]
    if name == "timestamp":
        return "timestamp_ntz"
    return "string" if name.endswith("clob") else f"varchar({numbers[0]})"


def with_database_ddl(specs: dict[str, TableSpec], ddl: str) -> dict[str, TableSpec]:
    """Give tables the columns of the CREATE TABLE statements of a staging database (one column a line).

    A prefix STG_<system>_ of the table names is dropped; tables the text does
    not create keep what they had.
    """
    out = dict(specs)
    for name, body in _CREATE.findall(ddl):
        columns = [m.groups() for m in map(_DDL_COLUMN.match, body.splitlines()) if m]
        if name.lower() in out and columns:
            out[name.lower()] = out[name.lower()].with_schema(", ".join(
                f"`{c.lower()}` {database_type(t, size)}{' not null' if 'not null' in rest.lower() else ''}"
                for c, t, size, rest in columns))
    return out
