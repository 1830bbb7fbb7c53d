"""Load checks and run reports over the supplied tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from quayside.operators import quality as dq, reporting as rp
from quayside.plans.registry import all_tables
from quayside.plans.run import Warehouse
from quayside.session import new_folder
from workload.merge_queries import _frames_sql, _sides
from workload.roles import role_cte, roles, table

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def reconcile(spark, sf):
    dw, stg = _sides(spark, sf)
    raw = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return dq.reconcile(raw, stg, dw, "id", sample=5)


def reconcile_all_keys(spark, sf):
    dw, stg = _sides(spark, sf)
    return dq.reconcile(stg, stg, dw, "id")


def missing(spark, sf):
    dw, stg = _sides(spark, sf)
    return dq.missing_keys(stg, dw, "id")


def missing_sample(spark, sf):
    """The lowest keys of the snapshot against a warehouse of paid orders' customers."""
    stg = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    dw = table(spark, sf, "orders").select((F.col("o_custkey") + 2).alias("id"))
    return dq.missing_keys(stg, dw, "id", sample=5)


def null_key_count(spark, sf):
    return dq.null_keys(_sides(spark, sf)[1], "id")


def merge_check(spark, sf):
    dw, stg = _sides(spark, sf)
    return dq.check_merge(stg, dw, updates=10, inserts=5)


def types(spark, sf):
    pages = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "cast(cast(o_totalprice as decimal(12,2)) as string) as price",
        "case when o_orderstatus = 'P' then 'n/a' else cast(o_custkey as string) end as customer", "o_orderpriority as priority",
        "o_totalprice as total")
    return dq.check_types(pages, {"id": "bigint", "price": "double", "customer": "bigint", "priority": "string", "total": "bigint"})


def types_sampled(spark, sf):
    df = table(spark, sf, "orders").selectExpr("o_orderkey as id", "'x' || o_orderstatus as status")
    return dq.check_types(df, {"id": "bigint", "status": "bigint"}, sample=10)


def orphan_rows(spark, sf):
    t = roles(spark, sf, "reservations", "boats")
    return dq.orphans(t["reservations"], t["boats"], "boat_id", "id")


def orphan_total(spark, sf):
    t = roles(spark, sf, "reservations", "boats")
    return dq.orphan_count(t["reservations"], t["boats"], "boat_id", "id")


def diff(spark, sf):
    dw, stg = _sides(spark, sf)
    return dq.field_diff(stg, dw, "id", ["price", "status", "note"])


def diff_by_checksums(spark, sf):
    """Two states of the customers that differ in few rows: only their buckets are opened."""
    columns = ["c_name", "c_acctbal", "c_mktsegment"]
    old = table(spark, sf, "customer").select("c_custkey", *columns)
    new = old.withColumn("c_acctbal", F.when(F.col("c_custkey") % 97 == 5, F.lit(None)).otherwise(F.col("c_acctbal"))).withColumn(
        "c_name", F.when(F.col("c_custkey") % 101 == 7, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")))
    return dq.field_diff(old, new, "c_custkey", ["c_name", "c_mktsegment"], keys_unique=True).unionByName(
        dq.field_diff(old.select("c_custkey", F.col("c_acctbal").isNull().alias("no_balance")),
                      new.select("c_custkey", F.col("c_acctbal").isNull().alias("no_balance")), "c_custkey", ["no_balance"], keys_unique=True))


def equal_tables(spark, sf):
    """Buckets of lines that differ between a table and itself in another order: none; and against one without a status: all."""
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber as id", "l_quantity", "l_returnflag")
    other = lines.withColumn("l_returnflag", F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("l_returnflag")))
    counts = lambda name, right: dq.differing_buckets(lines, right, "id", ["l_quantity", "l_returnflag"]).agg(
        (F.count(F.lit(1)) > 0).alias("differs")).select(F.lit(name).alias("pair"), "differs")
    return counts("same", lines.repartition(3, "l_quantity")).unionByName(counts("other", other))


def diff_sampled(spark, sf):
    dw, stg = _sides(spark, sf)
    return dq.field_diff(stg.filter("id is not null"), dw, "id", ["price", "status", "note"], sample=100)


def totals(spark, sf):
    dw, stg = _sides(spark, sf)
    return dq.change_totals(stg, dw, "id", ["price", "status", "note"])


def load_counts(spark, sf):
    return rp.load_counts({t: table(spark, sf, t) for t in TABLES})


def outcomes(spark, sf):
    """Orders per customer nation and priority as if they were merge counts."""
    counts = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 25).alias("k"), "o_orderpriority").agg(
        F.count_if(F.expr("o_orderstatus = 'F' and o_custkey % 2 = 0")).alias("inserted"),
        F.count_if(F.expr("o_orderstatus = 'O' and o_custkey % 3 = 0")).alias("updated"))
    name = F.concat(F.lit("T"), F.col("k").cast("string"), F.lit("_"), F.left("o_orderpriority", F.lit(1)))
    return counts.select(name.alias("table_name"), "inserted", "updated",
                         rp.merge_outcome(name, F.col("inserted"), F.col("updated")).alias("outcome"))


_MESSAGE = """case o_orderkey % 6 when 0 then 'ORA-01843: not a valid month'
 when 1 then 'ORA-01400: cannot insert NULL into ("DW"."T' || cast(o_custkey as string) || '"."ID")'
 when 2 then 'ORA-01400: cannot insert NULL' when 3 then 'ORA-00932: inconsistent datatypes'
 when 4 then 'ORA-01036: illegal variable name/number'
 else 'Error in order ' || cast(o_orderkey as string) || ': ' || repeat(o_orderpriority || ' ', 20) end"""


def error_classes(spark, sf):
    log = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_MESSAGE} as message")
    return log.select("o_orderkey", "message", rp.error_class(F.col("message")).alias("error_class"))


def summary(spark, sf):
    stats = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("system"), F.concat(F.lit("t_"), (F.col("o_custkey") % 25).cast("string")).alias("table_name")
    ).agg(F.count(F.lit(1)).alias("records"))
    log = table(spark, sf, "events").selectExpr("event_type as level", "event_id as seq", "event_type || ' of user ' || cast(user_id as string) as message")
    return rp.run_summary(stats, log)


def run_report(spark, sf):
    """Two tables loaded and merged, one with rows whose date does not read; then every check of the run."""
    run_ts, wh = datetime(2024, 1, 2, 6), Warehouse(spark, new_folder(spark, "report"))
    specs = {n: all_tables()[n] for n in ("piers", "bookings")}
    raw = {
        "piers": table(spark, sf, "supplier").selectExpr("cast(s_suppkey as string) as Id", "s_name as Name"),
        "bookings": table(spark, sf, "orders").selectExpr(
            "cast(o_orderkey as string) as id",
            "case when o_orderpriority = '1-URGENT' then 'soon' else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end as created_at"),
    }
    wh.load(raw, specs, run_ts)
    wh.merge_all(specs, run_ts, skip_at_once=True)
    return wh.report(raw, specs)


QUERIES = {
    "rp_run_report": run_report, "dq_reconcile": reconcile, "dq_reconcile_all_keys": reconcile_all_keys, "dq_missing_keys": missing,
    "dq_missing_keys_sample": missing_sample, "dq_null_keys": null_key_count, "dq_check_merge": merge_check,
    "dq_check_types": types, "dq_check_types_sample": types_sampled, "dq_orphans": orphan_rows,
    "dq_orphan_count": orphan_total, "dq_field_diff": diff, "dq_field_diff_sample": diff_sampled,
    "dq_field_diff_checksums": diff_by_checksums, "dq_equal_tables": equal_tables,
    "dq_change_totals": totals, "rp_load_counts": load_counts, "rp_merge_outcome": outcomes,
    "rp_error_class": error_classes, "rp_run_summary": summary,
}

_FIELDS = ("price", "status", "note")


def _diff_sql(stg: str) -> str:
    return " union all ".join(
        f"select s.id, '{c}' as column_name, cast(s.{c} as varchar) as left_value, cast(d.{c} as varchar) as right_value "
        f"from {stg} s join dw d on s.id = d.id where s.{c} is distinct from d.{c}" for c in _FIELDS)


_ANY = " or ".join(f"s.{c} is distinct from d.{c}" for c in _FIELDS)
_SUM = " + ".join(f"cast(s.{c} is distinct from d.{c} as integer)" for c in _FIELDS)

ORACLE = {
    "rp_run_report": """
with b as (select count(*) as n, count(*) filter (where o_orderpriority <> '1-URGENT') as good from orders), p as (select count(*) as n from supplier)
select 'piers' as table_name, 'source rows staged' as check_name, n as expected, n as actual, true as passed from p
union all select 'piers', 'staged rows in warehouse', n, n, true from p
union all select 'piers', unnest(['source keys missing', 'NULL keys staged', 'rows set aside']), 0, 0, true
union all select 'bookings', 'source rows staged', n, good, n = good from b
union all select 'bookings', 'staged rows in warehouse', good, good, true from b
union all select 'bookings', unnest(['source keys missing', 'rows set aside']), 0, n - good, n = good from b
union all select 'bookings', 'NULL keys staged', 0, 0, true""",
    "dq_reconcile": f"""{_frames_sql()},
n as (select (select count(*) from orders) as raw, (select count(*) from stg) as stg, (select count(*) from dw) as dw,
  (select count(*) from (select o_orderkey as id from orders order by 1 limit 5) k where id not in (select id from dw)) as lost,
  (select count(*) from stg where id is null) as nulls)
select 'source rows staged' as check_name, raw as expected, stg as actual, raw = stg as passed from n
union all select 'staged rows in warehouse', stg, dw, dw >= stg from n
union all select 'source keys missing', 0, lost, lost = 0 from n
union all select 'NULL keys staged', 0, nulls, nulls = 0 from n""",
    "dq_reconcile_all_keys": f"""{_frames_sql()},
n as (select (select count(*) from stg) as stg, (select count(*) from dw) as dw,
  (select count(distinct id) from stg where id is not null and id not in (select id from dw)) as lost,
  (select count(*) from stg where id is null) as nulls)
select 'source rows staged' as check_name, stg as expected, stg as actual, true as passed from n
union all select 'staged rows in warehouse', stg, dw, dw >= stg from n
union all select 'source keys missing', 0, lost, lost = 0 from n
union all select 'NULL keys staged', 0, nulls, nulls = 0 from n""",
    "dq_missing_keys": f"{_frames_sql()} select distinct id from stg where id is not null and id not in (select id from dw)",
    "dq_missing_keys_sample": "select c_custkey as id from (select c_custkey from customer order by 1 limit 5) where c_custkey not in (select o_custkey + 2 from orders)",
    "dq_null_keys": f"{_frames_sql()} select count(*) as null_keys from stg where id is null",
    "dq_check_merge": f"""{_frames_sql()}
select 'staged rows in warehouse' as check_name, (select count(*) from stg) as expected, (select count(*) from dw) as actual,
  (select count(*) from stg) <= (select count(*) from dw) as passed
union all select 'updates and inserts', 15, (select count(*) from stg), (select count(*) from stg) = 15""",
    "dq_check_types": """
select 'id' as column_name, 'bigint' as expected, 'bigint' as actual, 0 as bad_values, true as passed
union all select 'price', 'double', 'string', 0, true
union all select 'customer', 'bigint', 'string', count(*) filter (where o_orderstatus = 'P'), count(*) filter (where o_orderstatus = 'P') = 0 from orders
union all select 'priority', 'string', 'string', 0, true
union all select 'total', 'bigint', 'double', count(*), false from orders""",
    "dq_check_types_sample": """select 'id' as column_name, 'bigint' as expected, 'bigint' as actual, 0 as bad_values, true as passed
union all select 'status', 'bigint', 'string', 10, false""",
    "dq_orphans": f"with {role_cte('reservations', 'boats')} select boat_id, count(*) as n_rows from r_reservations where boat_id is not null and boat_id not in (select id from r_boats) group by boat_id",
    "dq_orphan_count": f"with {role_cte('reservations', 'boats')} select count(*) as orphan_rows, count(distinct boat_id) as orphan_keys from r_reservations where boat_id is not null and boat_id not in (select id from r_boats)",
    "dq_field_diff": f"{_frames_sql()} {_diff_sql('stg')}",
    "dq_field_diff_checksums": """
select c_custkey, 'c_name' as column_name, c_name as left_value, c_name || '!' as right_value from customer where c_custkey % 101 = 7
union all select c_custkey, 'no_balance', 'false', 'true' from customer where c_custkey % 97 = 5""",
    "dq_equal_tables": """
select 'same' as pair, false as differs union all select 'other', count(*) filter (where l_returnflag = 'R') > 0 from lineitem""",
    "dq_field_diff_sample": f"{_frames_sql()}, few as (select * from stg where id in (select id from stg where id is not null order by id limit 100)) {_diff_sql('few')}",
    "dq_change_totals": f"{_frames_sql()} select count(*) as records, count(*) filter (where {_ANY}) as records_with_changes, cast(sum({_SUM}) as bigint) as fields_changed from stg s join dw d on s.id = d.id",
    "rp_load_counts": "select table_name, cast(sum(records) as bigint) as records from (" + " union all ".join(
        f"select '{t}' as table_name, count(*) as records from {t}" for t in TABLES) + ") group by rollup (table_name)",
    "rp_merge_outcome": """
select table_name, inserted, updated, table_name || ': ' || case
  when inserted > 0 and updated > 0 then format('{:,}', inserted) || ' new record(s) inserted, ' || format('{:,}', updated) || ' existing record(s) updated'
  when inserted > 0 then format('{:,}', inserted) || ' new record(s) inserted'
  when updated > 0 then format('{:,}', updated) || ' existing record(s) updated'
  else 'No changes (data already up to date)' end as outcome
from (select 'T' || cast(o_custkey % 25 as varchar) || '_' || left(o_orderpriority, 1) as table_name,
  count(*) filter (where o_orderstatus = 'F' and o_custkey % 2 = 0) as inserted,
  count(*) filter (where o_orderstatus = 'O' and o_custkey % 3 = 0) as updated from orders group by o_custkey % 25, o_orderpriority)""",
    "rp_error_class": f"""select o_orderkey, message, case when contains(message, 'ORA-01843') then 'Date format error'
  when contains(message, 'ORA-01400') then 'NULL constraint: ' || case when regexp_extract(message, '"([^"]+)"', 1) = '' then 'unknown column' else regexp_extract(message, '"([^"]+)"', 1) end
  when contains(message, 'ORA-00932') then 'Data type mismatch' when contains(message, 'ORA-01036') then 'Bind variable count mismatch'
  else left(message, 100) end as error_class from (select o_orderkey, {_MESSAGE} as message from orders)""",
    "rp_run_summary": """
with stats as (select o_orderpriority as system, 't_' || cast(o_custkey % 25 as varchar) as table_name, count(*) as records from orders group by all),
log as (select event_type as level, event_id as seq, event_type || ' of user ' || cast(user_id as varchar) as message from events),
s as (select *, row_number() over (partition by system order by table_name) as no, count(*) over (partition by system) as n, sum(records) over (partition by system) as total from stats),
g as (select *, row_number() over (partition by level order by seq) as no, count(*) over (partition by level) as n from log)
select distinct system as section, 0 as line_no, 'Total Records' as item, cast(total as bigint) as records from s
union all select distinct system, 1, 'Tables Processed', n from s
union all select system, no + 1, table_name, records from s where no <= 5
union all select distinct system, 7, '... and ' || (n - 5) || ' more tables', n - 5 from s where n > 5
union all select distinct level, 0, 'Messages', n from g
union all select level, no + 1, message, null from g where no <= 3
union all select distinct level, 5, '... and ' || (n - 3) || ' more messages', n - 3 from g where n > 3""",
}
