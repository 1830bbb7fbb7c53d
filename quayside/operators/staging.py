"""Snapshot text into typed staging tables: convert, set bad rows aside, replace."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import VarcharType

from quayside.operators.store import Store
from quayside.plans.registry import MARINA, RENTAL, ColumnSpec, TableSpec
from quayside.sources.csv_tables import by_header, places

REPLACED, LEFT, EMPTIED, FAILED = "replaced", "left as it was", "emptied", "failed"
NO_ROWS = "No data rows in CSV file"  # fixed value
NOT_FOUND = "file not in archive"
LOAD_RESULT = ("table_name string, records bigint, bad_rows bigint, columns_not_found string, outcome string, "
               "message string")


class BadRows(ValueError):
    """Text a strict column cannot take, or nothing where a value is required."""


def _stored_type(c: ColumnSpec) -> str:
    return "string" if isinstance(c.type, VarcharType) else c.type.simpleString()


def _value(c: ColumnSpec) -> Column:
    return c.convert(F.col(f"`{c.name}`")).try_cast(_stored_type(c))


def _turned_down(c: ColumnSpec) -> Column:
    raw = F.col(f"`{c.name}`")
    if c.required:
        return _value(c).isNull()
    if c.length:  # strict text only has its length to fail by
        return F.coalesce(F.length(raw) > c.length, F.lit(False))
    return _value(c).isNull() & F.coalesce(F.btrim(raw) != "", F.lit(False))


def convert_rows(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Every raw row once: typed columns, `_bad`, and for bad rows the columns at fault and the raw text.

    Staging columns the load does not fill are NULL.
    """
    loaded = spec.loaded_columns
    text = by_header(raw, {c.name: c.header for c in loaded})
    strict = [c for c in loaded if c.strict or c.required]
    # all tests evaluated side by side, so that each shares its conversion with the column's value
    bad = F.greatest(F.lit(False), F.lit(False), *[_turned_down(c) for c in strict])
    at_fault = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(_turned_down(c), F.lit(c.name)) for c in strict]))
    filled = {c.name for c in loaded}
    return text.select(
        *[(_value(c) if c.name in filled else F.lit(None).cast(_stored_type(c))).alias(c.name) for c in spec.columns],
        F.when(bad, at_fault).alias("_bad_columns"),
        F.when(bad, F.to_json(F.struct(*text.columns))).alias("_raw"),
        bad.alias("_bad"),
    )


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("_bad")).drop("_bad_columns", "_raw", "_bad")


def bad_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_bad")).select("_bad_columns", "_raw")


def convert_table(raw: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(typed staging rows, bad rows as (_bad_columns, _raw JSON text))."""
    rows = convert_rows(raw, spec)
    return good_rows(rows), bad_rows(rows)


def not_found(raw: DataFrame, spec: TableSpec) -> list[str]:
    """Columns the load should fill, but the file has no header for."""
    loaded = spec.loaded_columns
    return [c.name for c, i in zip(loaded, places(raw.columns, [c.header for c in loaded])) if i is None]


def stage(store: Store, name: str, rows: DataFrame, *, only_if_filled: bool = False, fail_on_bad: bool = False,
          columns_not_found: list[str] = ()) -> DataFrame:
    """Replace staging table `name` by `rows`; returns one row of LOAD_RESULT.

    Converted rows are written in one pass, good and bad ones into a partition
    each, and counted on the way; the new version is committed afterwards or not at
    all. `only_if_filled` leaves the table alone when no row of the snapshot
    can be loaded; `fail_on_bad` when one cannot.
    """
    if "_bad" not in rows.columns:
        rows = rows.withColumn("_bad", F.lit(False))
    # counted while they are written: nothing is read back for it
    counts = Observation()
    observed = rows.observe(counts, F.count(F.lit(1)).alias("all"), F.count_if("_bad").alias("bad"))
    folder, written = store.prepare(name, observed, partition_by=("_bad",))
    bad = counts.get["bad"]
    good = counts.get["all"] - bad
    missing = ", ".join(columns_not_found) or None
    if bad and (fail_on_bad or only_if_filled and not good):
        at_fault = sorted(bad_rows(written).first()["_bad_columns"])
        store.discard(folder)
        if fail_on_bad:
            raise BadRows(f"{name}: unreadable text in {at_fault}")
        result = (name, 0, bad, missing, LEFT, f"no row could be loaded: unreadable text in {at_fault}")
    elif only_if_filled and not good:
        store.discard(folder)
        result = (name, 0, 0, missing, LEFT, NO_ROWS)
    else:
        store.commit_whole(name, folder, rows.schema.json())
        result = (name, good, bad, missing, REPLACED, None)
    return store.spark.createDataFrame([result], LOAD_RESULT)


def staged(store: Store, name: str) -> DataFrame | None:
    """The last snapshot of a table, bad rows left out."""
    rows = store.read(name)
    return good_rows(rows) if rows is not None else None


def set_aside(store: Store, name: str) -> DataFrame | None:
    """The bad rows of the last snapshot."""
    rows = store.read(name)
    return bad_rows(rows) if rows is not None and "_raw" in rows.columns else None


def load_table(store: Store, raw: DataFrame, spec: TableSpec, *, on_bad_rows: str = "set aside") -> DataFrame:
    """Convert and stage one table. `on_bad_rows`: "set aside" keeps them apart, "fail" rejects the table.

    The rental system's tables are only replaced by a snapshot that has rows.
    """
    return stage(store, spec.name, convert_rows(raw, spec), only_if_filled=spec.system == RENTAL,
                 fail_on_bad=on_bad_rows == "fail", columns_not_found=not_found(raw, spec))


def clear(store: Store, name: str) -> None:
    """Leave staging table `name` without rows, if there is one."""
    rows = store.read(name)
    if rows is not None:
        store.write(name, rows.limit(0), partition_by=("_bad",))


def load_all(store: Store, raw: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], *,
             on_bad_rows: str = "set aside", after=None, at_a_time: int = 4) -> DataFrame:
    """Load every table, a few at a time; one that fails is reported and the rest go on.

    A marina table that is not in the snapshot, or fails, ends up empty, as all
    of that system's staging is replaced at once; a rental table stays as it
    was. `after(spec)` runs after each table that was replaced (merge right
    after load).
    """

    def one(item):
        name, spec = item
        at_once = spec.system == MARINA
        if name not in raw:
            if at_once:
                clear(store, name)
            return (name, 0, 0, None, EMPTIED if at_once else FAILED, NOT_FOUND)
        try:
            result = tuple(load_table(store, raw[name], spec, on_bad_rows=on_bad_rows).first())
        except Exception as e:  # one table's failure is its own; see the result
            if at_once:
                clear(store, name)
            return (name, 0, None, None, FAILED, str(e))
        try:
            if after and result[4] == REPLACED:
                after(spec)
            return result
        except Exception as e:
            return (*result[:4], FAILED, str(e))

    with ThreadPoolExecutor(max_workers=at_a_time) as pool:
        results = list(pool.map(one, specs.items()))
    return store.spark.createDataFrame(results, LOAD_RESULT)
