"""General-ledger lines of fourteen document types and the profit report over them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quayside.operators.lookup import left_lookup

NOTHING = -99999  # placeholder key of lines without an entity or an item


@dataclass(frozen=True)
class Document:
    """How one document type departs from the common line layout."""

    t_type: str
    entity: str | None = "entity"  # line column; None: placeholder
    item: bool = True  # False: placeholder item and no quantity
    account: str = "account"
    credit: str = "accountingbook_credit"
    debit: str = "accountingbook_debit"
    name: str = "line.trandisplayname"
    quantity: bool = True


def _no_item(t_type: str, **other) -> Document:
    return Document(t_type, item=False, quantity=False, **other)


# Type labels as the report shows them and the columns they differ in.
DOCUMENTS = {
    "journal": _no_item("journal"),
    "vendor_bill": Document("vendbill", entity="vendor"),
    "vendor_credit": Document("vendcred"),
    "check": _no_item("check"),
    "deposit": _no_item("deposit", entity=None),
    "cash_sale": Document("cashsale"),
    "invoice": Document("Invoice"),
    "vendor_bill_payment": _no_item("vendbillpayment", entity="vendor"),
    "customer_credit": _no_item("customercredit", entity="customer"),
    "customer_payment": _no_item("customerpayment", entity="customer"),
    "customer_refund": _no_item("customerrefund", entity="customer"),
    "credit_card": _no_item("creditcard"),
    "depreciation": _no_item(
        "DEPENTRY", account="expenseaccount", credit="creditforeignamount", debit="debitforeignamount",
        name="header.tranid",
    ),
    "credit_card_refund": _no_item("ccrefund"),
}


# the common columns of a ledger line, in order; those of the account come with the join
_COLUMNS = ("t_type", "tran_id", "internalid", "line_id", "tran_date", "tran_name", "subsidiary_id", "location_id", "division_id",
            "department_id", "entity_id", "item_id", "posting_period_id", "account_id", "account_number", "account_type",
            "account_desc", "qty", "ext_cost", "acctg_amount", "memo")


def _headers(header: DataFrame, doc: Document, book: int) -> DataFrame:
    """Posted documents of one type; `book` numbers the table that holds their lines."""
    return header.filter("posting = 'T'").selectExpr(
        f"{book} as _t_book", f"'{doc.t_type}' as t_type", "tranid as tran_id", "id as internalid", "trandate as tran_date",
        "postingperiod as posting_period_id")


def _own(doc: Document) -> dict[str, str]:
    """The columns in which document types differ, as expressions over a line."""
    placeholder = f"cast({NOTHING} as bigint)"
    return {
        "tran_name": doc.name if doc.name.startswith("line.") else "cast(null as string)",
        "entity_id": f"cast({doc.entity} as bigint)" if doc.entity else placeholder,
        "item_id": "cast(item as bigint)" if doc.item else placeholder,
        "account_id": doc.account,
        "qty": f"cast({'-quantity' if doc.quantity else 'null'} as decimal(20,2))",
        "acctg_amount": f"cast(coalesce({doc.credit}, 0) - coalesce({doc.debit}, 0) as decimal(20,2))",
    }


def _lines(line: DataFrame, docs: list[Document], variants: Mapping[str, list[str]], book: int) -> DataFrame:
    """The lines of a table that these document types share, each once: the book and the document's id are the key of their header.

    Column `_<column>_<n>` is the n-th of its `variants`, null if none of these types takes it.
    """
    taken = {(c, e) for d in docs for c, e in _own(d).items()}
    return line.alias("line").selectExpr(
        f"{book} as _book",
        "transaction as _transaction",
        "id as line_id",
        "subsidiary as subsidiary_id",
        "location as location_id",
        "class as division_id",
        "department as department_id",
        "cast(null as decimal(20,2)) as ext_cost",
        "memo",
        *[f"{e if (c, e) in taken else 'null'} as _{c}_{n}" for c, found in variants.items() for n, e in enumerate(found)],
    )


def _posted(ledger: Mapping[str, tuple[DataFrame, DataFrame]], kinds) -> DataFrame:
    """Posted lines of some document types, all but the columns of the account they are booked on.

    Headers of all types are one table, tagged with their type, and so are the
    lines; they meet in one join. A line table that several types share is read
    and shuffled once, and a line's type is known behind the join.
    """
    books: list[tuple[DataFrame, list[str]]] = []  # line tables and the types that share them
    for kind in kinds:
        shared = next((of for line, of in books if line is ledger[kind][1]), None)
        if shared is None:
            books.append((ledger[kind][1], shared := []))
        shared.append(kind)
    own = {k: _own(DOCUMENTS[k]) for k in kinds}
    variants = {c: list(dict.fromkeys(own[k][c] for k in kinds)) for c in own[kinds[0]]}
    headers = reduce(DataFrame.unionByName, [_headers(ledger[k][0], DOCUMENTS[k], i) for i, (_, of) in enumerate(books) for k in of])
    lines = reduce(DataFrame.unionByName, [_lines(line, [DOCUMENTS[k] for k in of], variants, i) for i, (line, of) in enumerate(books)])

    def chosen(column: str) -> Column:
        """The variant of the line's own type."""
        found = [F.when(F.col("t_type").isin(*[DOCUMENTS[k].t_type for k in kinds if own[k][column] == e]), F.col(f"_{column}_{n}"))
                 for n, e in enumerate(variants[column])]
        return F.coalesce(*found)  # those of other types are null

    named = {c: chosen(c) for c in variants}
    of_header = [DOCUMENTS[k].t_type for k in kinds if DOCUMENTS[k].name == "header.tranid"]
    named["tran_name"] = F.when(F.col("t_type").isin(*of_header), F.col("tran_id").cast("string")).otherwise(named["tran_name"])
    met = headers.join(lines, (F.col("_t_book") == F.col("_book")) & (F.col("internalid") == F.col("_transaction")))
    return met.withColumns(named)


def _on_account(lines: DataFrame, account: DataFrame, *more: str) -> DataFrame:
    """Lines with the account they are booked on; lines without one are left out."""
    named = account.select("id", F.col("acctnumber").alias("account_number"), F.col("accttype").alias("account_type"),
                           F.col("description").alias("account_desc"), *more)
    return lines.join(named, F.col("account_id") == F.col("id")).select(*_COLUMNS, *more)


def ledger_lines(header: DataFrame, line: DataFrame, account: DataFrame, doc: Document) -> DataFrame:
    """Posted lines of one document type in the common 21 columns."""
    kind = next(k for k, d in DOCUMENTS.items() if d == doc)
    return _on_account(_posted({kind: (header, line)}, [kind]), account)


def all_lines(ledger: Mapping[str, tuple[DataFrame, DataFrame]], account: DataFrame, *more: str) -> DataFrame:
    """UNION ALL of every document type; `ledger` maps a DOCUMENTS key to (header, line).

    The account is joined once, to the lines of all types; `more` names further columns of it to carry along.
    """
    return _on_account(_posted(ledger, list(DOCUMENTS)), account, *more)


def finance_report(ledger: Mapping[str, tuple[DataFrame, DataFrame]], d: Mapping[str, DataFrame]) -> DataFrame:
    """The lines of all document types with names, posting month and profit columns.

    Most lines carry the placeholder as item, many as entity, and either may be
    NULL; those rows are spread over all partitions instead of meeting in one.
    """
    spread = [F.col("internalid"), F.col("line_id"), F.col("t_type")]

    def named(df, table, key, source, target, placeholders=(), spread_by=None):
        dim = d[table].select("id", F.col(source).alias(target))
        return left_lookup(df, dim, key, "id", placeholders=placeholders, spread_by=spread_by)

    u = all_lines(ledger, d["account"], "accountsearchdisplayname")
    u = named(u, "subsidiary", "subsidiary_id", "name", "subsidiary")
    u = named(u, "location", "location_id", "name", "location")
    u = named(u, "classification", "division_id", "name", "class")
    u = named(u, "department", "department_id", "name", "department")
    parties = [d["customer"].select("id", F.col("entityid").alias("customer")), d["vendor"].select("id", F.col("entityid").alias("tran_vendor"))]
    u = left_lookup(u, parties, "entity_id", "id", placeholders=(NOTHING,), spread_by=spread)
    u = named(u, "item", "item_id", "itemid", "item_name", (NOTHING,), spread)
    u = named(u, "accounting_period", "posting_period_id", "periodname", "_period")
    keys = d["account_key"].select(
        F.col("nsaccount").cast("string").alias("id"), F.col("modelmappingdetail").alias("mapvalue"),
        "sortorder", "reporttype", "reportsection",
    )
    u = left_lookup(u, keys, "account_number", "id")

    amount, kind = F.col("acctg_amount"), F.col("account_type")
    zero = F.lit(0).cast("decimal(20,2)")

    def of(account_type):
        return F.when(kind == account_type, amount).otherwise(zero)

    month, year = F.substring("_period", 1, 3), F.substring("_period", 5, 8)
    month_start = F.try_to_timestamp(F.concat(F.lit("01-"), month, F.lit("-"), year), F.lit("dd-MMM-yyyy"))
    return u.select(
        "t_type", "tran_id", "internalid", "line_id", "tran_date", "tran_name", "subsidiary", "location", "class",
        "department", "customer", "tran_vendor", "item_name",
        "account_number", "account_type", F.col("accountsearchdisplayname").alias("account_desc"),
        year.alias("posting_year"),
        month.alias("posting_month"),
        # a period name that is no month gives NULL instead of failing the report
        F.date_format(month_start, "yyyyMM").cast("int").alias("posting_month_num"),
        amount.alias("acctg_amount"),
        of("Income").alias("income_amount"),
        of("COGS").alias("cogs_amount"),
        of("Expense").alias("expense_amount"),
        of("OthIncome").alias("otherincome_amount"),
        of("OthExpense").alias("otherexpense_amount"),
        (of("Income") + of("COGS")).cast("decimal(20,2)").alias("gross_profit"),
        F.when(kind.isin("Income", "COGS", "Expense", "OthIncome", "OthExpense"), amount).otherwise(zero).alias("net_profit"),
        "memo", "mapvalue", "sortorder", "reporttype", "reportsection",
    )
