"""The reports and merges when one key holds a third of all rows, with and without broadcasts."""

import os

import pytest

import __spark_entry__ as driver
from compare import diff, duck

QUERIES, ORACLE = driver.queries(), driver.oracle_sql()
NAMES = [n for n in QUERIES if n.startswith(("vw_daily", "vw_res", "vw_fin", "dq_", "mg_upsert"))] + [
    "vw_ledger_invoice", "mg_duplicate_keys", "mg_duplicates_inserted", "mg_surrogate_keys", "mg_stored_table"]
# events of one user, orders and lines of one customer, berth, document and part
HOT = {
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 37 else o_custkey end as o_custkey) from {t}",
    "lineitem": "select * replace (case when l_linenumber % 3 = 0 then 42 else l_orderkey end as l_orderkey, "
                "case when l_linenumber % 3 = 1 then 7 else l_partkey end as l_partkey) from {t}",
    "events": "select * replace (case when event_id % 3 = 0 then 5 else user_id end as user_id) from {t}",
}


@pytest.fixture(scope="module")
def hot(sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = duck(sf)
    for f in os.listdir(sf):
        if (name := f.removesuffix(".parquet")) in HOT:
            con.execute(f"copy ({HOT[name].format(t=name)}) to '{folder}/{f}' (format parquet)")
        else:
            os.symlink(f"{sf}/{f}", folder / f)
    return str(folder)


@pytest.fixture(params=["10MB", "-1"])
def threshold(spark, request):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, request.param)
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", NAMES)
def test_hot(spark, hot, threshold, name):
    assert diff(QUERIES[name](spark, hot), duck(hot), ORACLE[name]) is None


def test_hot_partition_is_split(spark, hot):
    """A document with a third of all lines: its partition is dealt out to several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    from quayside.plans import ledger
    from workload.roles import roles

    t = roles(spark, hot, "header", "line", "account")
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = ledger.ledger_lines(t["header"], t["line"].repartition(8), t["account"], ledger.DOCUMENTS["invoice"])
        lines.write.format("noop").mode("overwrite").save()
        execution = lines._jdf.queryExecution()
        execution.toRdd().count()
        assert "SortMergeJoin(skew=true)" in execution.executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
