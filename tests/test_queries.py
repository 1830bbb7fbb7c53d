"""Every registered query against its SQL on the supplied tables."""

import re

import pytest

import __spark_entry__ as driver
from compare import diff, duck

# the training-data operators have tests of their own
QUERIES = {n: q for n, q in driver.queries().items() if n != "pipeline" and not re.match(r"op\d+_", n)}
ORACLE = {n: sql for n, sql in driver.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert diff(df, con, ORACLE[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "calendar_date" and df.limit(1).count() == 1


# reports must stay free of nested loops and cross products
REPORTS = [n for n in QUERIES if n.startswith(("vw_", "dq_", "rp_"))]


@pytest.mark.parametrize("name", REPORTS)
def test_no_nested_loop(spark, sf, name, capsys):
    QUERIES[name](spark, sf).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_posting_filter_and_columns_reach_the_scan(spark, sf, capsys, tmp_path):
    from quayside.plans import ledger
    from workload.roles import roles

    t = roles(spark, sf, "header", "line", "account")
    for n, df in t.items():
        df.write.parquet(str(tmp_path / n))
    t = {n: spark.read.parquet(str(tmp_path / n)) for n in t}
    ledger.ledger_lines(t["header"], t["line"], t["account"], ledger.DOCUMENTS["journal"]).explain()
    plan = capsys.readouterr().out
    assert "EqualTo(posting,T)" in plan
    assert "expenseaccount" not in plan and "quantity" not in plan  # columns the journal does not show


def test_summary_limits_groups_before_the_shuffle(spark, sf, capsys):
    QUERIES["rp_run_summary"](spark, sf).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_a_line_table_of_several_types_is_read_once(spark, rows):
    """A table that types share is scanned once, whatever their number; one of its own is another book, even with the same ids."""
    from decimal import Decimal as D

    from quayside.plans import ledger

    keys = "subsidiary location class department entity vendor customer item account expenseaccount".split()
    money = "quantity accountingbook_credit accountingbook_debit creditforeignamount debitforeignamount".split()
    ddl = ", ".join(["id bigint, transaction bigint, trandisplayname string", *[f"{k} bigint" for k in keys], *[f"{m} decimal(12,2)" for m in money], "memo string"])

    def line(of, at, name):
        return (of, at, name, *[10 * of + i for i in range(8)], 1, 2, *[D(of + i) for i in range(5)], name.lower())

    kinds = list(ledger.DOCUMENTS)
    shared = rows(ddl, *[line(i, at, f"L{i}/{at}") for at in range(len(kinds)) for i in (1, 2)])
    own = rows(ddl, *[line(i, 3, f"Own {i}") for i in (7, 8)])
    account = rows("id bigint, acctnumber string, accttype string, description string", (1, "4000", "Income", "a"), (2, "5000", "COGS", "b"))
    heads = rows("id bigint, tranid string, trandate date, postingperiod bigint, posting string, kind int", *[
        (i, f"T{i}", None, 1, "F" if i == 5 else "T", i) for i in range(len(kinds))], (3, "T3 again", None, 1, "T", 4))
    books = {k: (heads.filter(f"kind = {i}"), own if k == "check" else shared) for i, k in enumerate(kinds)}
    found = ledger.all_lines(books, account)
    each = [r for k in kinds for r in ledger.ledger_lines(*books[k], account, ledger.DOCUMENTS[k]).collect()]
    assert len(each) == 2 * len(kinds) and {r.tran_name for r in each if r.t_type == "check"} == {"Own 7", "Own 8"}
    assert sorted(map(repr, found.collect())) == sorted(map(repr, each))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert sum("trandisplayname#" in x and x.strip(" :+-").startswith(("LogicalRDD", "Scan", "LocalRelation")) for x in plan.splitlines()) == 2
