"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_ROUNDS (default 2, the best round counts) steer it. Results go to Spark's
noop sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

from quayside.operators.staging import staged
from quayside.plans.registry import all_tables
from quayside.plans.run import Warehouse
from quayside.session import build, new_folder
from workload import merge_queries, report_queries, source_queries

HEADLINE = {
    **{n: report_queries.QUERIES[n] for n in (
        "vw_daily_boat_lengths", "vw_daily_slip_count", "vw_daily_slip_occupancy", "vw_reservation_rates",
        "vw_daily_rentals", "vw_ledger_invoice", "vw_finance_report")},
    **{n: merge_queries.QUERIES[n] for n in ("mg_upsert", "mg_upsert_changed", "mg_surrogate_keys")},
    **{n: source_queries.QUERIES[n] for n in ("src_zip_members", "cv_table_reservations", "cv_table_invoice_items")},
}


def two_days(spark, sf_dir) -> tuple[float, float, int]:
    """Text to warehouse, twice: convert, stage and merge reservations and invoice items.

    Returns the seconds of the first load, those of the next day's (a tenth of
    the rates and totals changed) and the rows of one day.
    """
    from pyspark.sql import functions as F
    from workload.roles import role

    specs = {n: all_tables()[n] for n in ("reservations", "invoice_items")}
    wh = Warehouse(spark, new_folder(spark, "bench"))
    seconds = []
    for day in (1, 2):
        raw = {}
        for name, amount in (("reservations", "rate"), ("invoice_items", "total")):
            df = role(spark, sf_dir, name)
            if name == "invoice_items":  # line numbers repeat in the supplied table; a key is needed here
                df = df.dropDuplicates(["id"])
            changed = (F.lit(day) == 2) & (F.pmod(F.xxhash64("id"), F.lit(10)) == 0)
            df = df.withColumn(amount, F.when(changed, F.col(amount) + 1).otherwise(F.col(amount)))
            folder = new_folder(spark, "bench-text")  # the text snapshot is made before the clock starts
            df.select([F.col(c).cast("string").alias(c) for c in df.columns]).repartition(16).write.parquet(folder)
            raw[name] = spark.read.parquet(folder)
        seconds.append(timed(lambda: wh.load(raw, specs, datetime(2024, 1, day)))[0])
    return seconds[0], seconds[1], sum(staged(wh.staging, n).count() for n in specs)


def timed(action) -> tuple[float, object]:
    start = time.perf_counter()
    result = action()
    return time.perf_counter() - start, result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "2"))
    only = sys.argv[1:]
    spark = build("quayside-bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name, query in HEADLINE.items():
        if only and name not in only:
            continue
        runs = [timed(lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())[0] for _ in range(rounds)]
        seconds[name] = round(min(runs), 3)
    moved = 0
    if not only or "load_and_merge" in only:
        runs = [two_days(spark, sf_dir) for _ in range(rounds)]
        moved = runs[0][2]
        seconds["load_and_merge"] = round(min(r[0] for r in runs), 3)
        seconds["load_and_merge_next_day"] = round(min(r[1] for r in runs), 3)
    out = {
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }
    if moved:
        out["load_and_merge_rows_per_sec"] = round(moved / seconds["load_and_merge"])
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
