"""A whole run: newest archives into staging, staging into the warehouse."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayside.operators.merge import merge_table, run_all
from quayside.operators.quality import reconcile
from quayside.operators.staging import load_all, set_aside, staged
from quayside.operators.store import Store
from quayside.plans.registry import MARINA, TableSpec
from quayside.sources.archives import found_members, land, latest_archive, list_archives, one_table, tar_records, zip_records
from quayside.sources.csv_tables import by_header

ARCHIVE_SUFFIX = {"marina": (".zip", True), "rental": ("-DATA.sql.gz", False)}  # fixed values: suffix, any case


class Warehouse:
    """Staging and warehouse tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.staging = Store(spark, f"{root.rstrip('/')}/staging")
        self.tables = Store(spark, f"{root.rstrip('/')}/warehouse")

    def unpack(self, folder: str, system: str, specs: dict[str, TableSpec]) -> dict[str, DataFrame]:
        """Raw text tables of the newest archive of a system; empty when there is no archive.

        The archive is unpacked once below the staging root, split by table.
        """
        suffix, any_case = ARCHIVE_SUFFIX[system]
        newest = latest_archive(list_archives(self.spark, folder), suffix, ignore_case=any_case)
        if newest.isEmpty():
            return {}
        headers = {s.source: [c.header for c in s.loaded_columns] for s in specs.values()}
        unpacked = zip_records(newest, headers) if system == MARINA else tar_records(newest, headers)
        records = land(unpacked, self.staging.scratch(f"landing-{system}"))
        found = {r["table_name"]: r["fields"] for r in found_members(records).collect()}  # one per listed table
        return {name: one_table(records, s.source, headers[s.source], found[s.source]) for name, s in specs.items() if s.source in found}

    def load(self, raw: dict[str, DataFrame], specs: dict[str, TableSpec], run_ts: datetime, *,
             on_bad_rows: str = "set aside", merge_at_once: bool = True, merged: dict[str, dict[str, int]] | None = None) -> DataFrame:
        """Stage every table; the flagged ones are merged as soon as they are staged, and `merged` takes what those merges say."""

        def merge_now(spec: TableSpec):
            if spec.at_once:
                counts = merge_table(self.tables, spec.name, spec.for_warehouse(staged(self.staging, spec.name)), spec.merge, run_ts)
                if merged is not None:
                    merged[spec.name] = counts

        return load_all(self.staging, raw, specs, on_bad_rows=on_bad_rows, after=merge_now if merge_at_once else None)

    def merge_all(self, specs: dict[str, TableSpec], run_ts: datetime, *, skip_at_once: bool = False) -> DataFrame:
        """Merge every staged table (all of them, whichever way each system used to be called).

        The versions that stand afterwards become one snapshot: `tables.read_together()` shows whole runs only.
        """
        ready = {
            name: (s.for_warehouse(df), s.merge) for name, s in specs.items()
            if not (skip_at_once and s.at_once) and (df := staged(self.staging, name)) is not None
        }
        merged = run_all(self.tables, ready, run_ts)
        self.tables.snapshot(list(specs))
        return merged

    def run(self, folder: str, specs: dict[str, TableSpec], run_ts: datetime) -> tuple[DataFrame, DataFrame, DataFrame]:
        """A whole day: the newest archive of each system to staging and warehouse, then checked.

        Returns what the load, the merge and the checks say, table by table. What was unpacked is removed.
        """
        raw, loaded, at_once = {}, None, {}
        for system in ARCHIVE_SUFFIX:
            own = {n: s for n, s in specs.items() if s.system == system}
            if own:
                found = self.unpack(folder, system, own)
                one = self.load(found, own, run_ts, merged=at_once)
                raw, loaded = {**raw, **found}, one if loaded is None else loaded.unionByName(one)
        merged = self.merge_all(specs, run_ts, skip_at_once=True)
        if at_once:
            rows = [(n, c["inserted"], c["updated"], c["kept"]) for n, c in at_once.items()]
            merged = merged.unionByName(self.spark.createDataFrame(rows, merged.schema))
        checks = self.report(raw, specs)
        checked = self.spark.createDataFrame(checks.collect(), checks.schema)  # a few rows per table
        self.discard_landing()
        return loaded, merged, checked

    def discard_landing(self) -> None:
        """Remove what archives were unpacked into, and what failed jobs left, once its tables are loaded."""
        for store in (self.staging, self.tables):
            store.discard(f"{store.root}/_scratch")

    def report(self, raw: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
        """Checks of a run, table by table: source against staging against warehouse (table_name, check_name, expected, actual, passed).

        Tables of which there is no snapshot, or
        nothing in the warehouse yet, have no rows here.
        """
        checked = None
        for name, spec in specs.items():
            staged_rows, stored = staged(self.staging, name), self.tables.read(name)
            if name not in raw or staged_rows is None or stored is None:
                continue
            key = next(c for c in spec.loaded_columns if c.name == spec.keys[0])
            keys = by_header(raw[name], {key.name: key.header}).select(
                key.convert(F.col(key.name)).try_cast(stored.schema[key.name].dataType).alias(key.name))
            aside = set_aside(self.staging, name).select(F.lit(None).cast(stored.schema[key.name].dataType).alias(key.name))
            one = reconcile(keys, staged_rows.select(key.name), stored.select(key.name), key.name)
            lost = aside.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("rows set aside").alias("check_name"), F.lit(0).cast("bigint").alias("expected"), F.col("n").alias("actual"), (F.col("n") == 0).alias("passed"))
            rows = one.unionByName(lost).select(F.lit(name).alias("table_name"), "*")
            checked = rows if checked is None else checked.unionByName(rows)
        return checked if checked is not None else self.spark.createDataFrame(
            [], "table_name string, check_name string, expected bigint, actual bigint, passed boolean")
