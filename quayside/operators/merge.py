"""Upsert of a full snapshot into a warehouse table: insert, update or keep, never delete."""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quayside.operators.numbering import number_rows
from quayside.operators.store import Store
from quayside.session import new_folder
from quayside.storage import Files

AUDIT = "dw_id bigint, dw_last_inserted timestamp_ntz, dw_last_updated timestamp_ntz"
INSERTED, UPDATED, KEPT = "insert", "update", "keep"

# Stand-ins for NULL in the change test of the compatibility mode.
SENTINELS = {"string": "~NULL~", "date": date(1900, 1, 1), "integer": -999, "fraction": -999.999}


class AmbiguousSource(ValueError):
    """Several snapshot rows claim the same existing warehouse row."""


@dataclass(frozen=True)
class MergeSpec:
    keys: tuple[str, ...]
    columns: tuple[str, ...]  # all staged columns, keys included
    compare: tuple[str, ...] | None = None  # None: every match is an update
    sentinels: bool = False  # NULL equals its stand-in value, as NVL comparisons have it


@dataclass(frozen=True)
class KeyProfile:
    repeated_in_source: bool
    repeated_in_target: bool
    ambiguous: int  # repeated snapshot keys that hit an existing row


def run_stamp(run_ts: datetime) -> Column:
    """The one time stamp of a run; a literal, so that retried tasks agree."""
    return F.to_timestamp_ntz(F.lit(run_ts.isoformat(sep=" ")))


def _has_key(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def key_profile(dw: DataFrame, stg: DataFrame, keys: tuple[str, ...]) -> KeyProfile:
    """Are keys unique on each side, and does a repeated snapshot key hit an existing row?

    Key columns only, counted per key before the shuffle, so a key that holds
    most rows arrives as one count per task.
    """
    source = stg.filter(_has_key(keys)).select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_d"))
    target = dw.filter(_has_key(keys)).select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_d"))
    per_key = source.unionByName(target).groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_d").alias("_d"))
    many_s, many_d = F.col("_s") > 1, F.col("_d") > 1
    return KeyProfile(*per_key.agg(
        F.coalesce(F.max(many_s), F.lit(False)), F.coalesce(F.max(many_d), F.lit(False)),
        F.count_if(many_s & (F.col("_d") > 0)),
    ).first())


def repeats(df: DataFrame, keys: tuple[str, ...]) -> bool:
    """Does a complete key occur more than once?"""
    counts = df.filter(_has_key(keys)).groupBy(*keys).count()
    return bool(counts.agg(F.max(F.col("count") > 1)).first()[0])


def duplicate_keys(dw: DataFrame, stg: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Repeated snapshot keys with their row count and whether they match (an error) or insert."""
    repeated = stg.filter(_has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    known = dw.select(*keys).distinct().withColumn("_known", F.lit(True))
    return repeated.join(known, list(keys), "left").select(
        *keys, "n_rows", F.when(F.col("_known"), "error").otherwise(INSERTED).alias("outcome")
    )


def _stand_in(dtype: str):
    if dtype in ("string",) or dtype.startswith(("varchar", "char")):
        return F.lit(SENTINELS["string"])
    if dtype.startswith(("date", "timestamp")):
        return F.lit(SENTINELS["date"]).cast(dtype)
    if dtype in ("double", "float") or (dtype.startswith("decimal") and not dtype.endswith(",0)")):
        return F.lit(SENTINELS["fraction"])
    return F.lit(SENTINELS["integer"])


def _changed(spec: MergeSpec, types: dict[str, str]) -> Column:
    if spec.compare is None:
        return F.lit(True)

    def differs(c):
        old, new = F.col(f"d.{c}"), F.col(f"s.{c}")
        if spec.sentinels:
            return F.coalesce(old, _stand_in(types[c])) != F.coalesce(new, _stand_in(types[c]))
        return ~old.eqNullSafe(new)

    return reduce(lambda a, b: a | b, [differs(c) for c in spec.compare], F.lit(False))


def existing_rows(dw: DataFrame, stg: DataFrame, spec: MergeSpec, run_ts: datetime, profile: KeyProfile) -> DataFrame:
    """Every warehouse row after the merge, with `_action` keep or update.

    Rows without a complete key match nothing and stay out of the join. The
    warehouse is the left side, so a hot key on it can be split; snapshot rows
    with repeated keys match nothing here (that is checked) and are left out.
    """
    keys = list(spec.keys)
    source = stg.filter(_has_key(keys)).select(*spec.columns)
    if profile.repeated_in_source:
        repeated = source.groupBy(*keys).count().filter("count > 1").select(*keys)
        source = source.join(repeated, keys, "left_anti")
    d = dw.filter(_has_key(keys)).alias("d")
    s = source.withColumn("_found", F.lit(True)).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys])
    update = F.coalesce(F.col("s._found"), F.lit(False)) & _changed(spec, dict(dw.dtypes))
    joined = d.join(s, on, "left").withColumn("_update", update)
    matched = joined.select(
        F.col("d.dw_id").alias("dw_id"),
        *[F.when(F.col("_update"), F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in spec.columns],
        F.col("d.dw_last_inserted").alias("dw_last_inserted"),
        F.when(F.col("_update"), run_stamp(run_ts)).otherwise(F.col("d.dw_last_updated")).alias("dw_last_updated"),
        F.when(F.col("_update"), UPDATED).otherwise(KEPT).alias("_action"),
    )
    keyless = dw.filter(~_has_key(keys)).select(
        "dw_id", *spec.columns, "dw_last_inserted", "dw_last_updated", F.lit(KEPT).alias("_action"))
    return matched.unionByName(keyless)


def new_rows(dw: DataFrame, stg: DataFrame, spec: MergeSpec, run_ts: datetime) -> DataFrame:
    """Snapshot rows that match no warehouse row, keyless ones included; not numbered yet."""
    keys = list(spec.keys)
    known = dw.select(*keys).filter(_has_key(keys)).distinct()
    fresh = stg.filter(_has_key(keys)).select(*spec.columns).join(known, keys, "left_anti").select(*spec.columns)
    keyless = stg.filter(~_has_key(keys)).select(*spec.columns)
    return fresh.unionByName(keyless).select(
        *spec.columns, run_stamp(run_ts).alias("dw_last_inserted"), run_stamp(run_ts).alias("dw_last_updated"),
        F.lit(INSERTED).alias("_action"),
    )


def outer_rows(dw: DataFrame, stg: DataFrame, spec: MergeSpec, run_ts: datetime) -> DataFrame:
    """Every row after the merge from one full outer join; new rows come without dw_id.

    For keys that are unique on both sides: each side is shuffled once, and no
    key can be hot. Rows without a complete key match nothing and stay out of
    the join.
    """
    keys, stamp = list(spec.keys), run_stamp(run_ts)
    d = dw.filter(_has_key(keys)).withColumn("_known", F.lit(True)).alias("d")
    s = stg.filter(_has_key(keys)).select(*spec.columns).withColumn("_found", F.lit(True)).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys])
    action = (
        F.when(F.col("d._known").isNull(), INSERTED)
        .when(F.col("s._found").isNotNull() & _changed(spec, dict(dw.dtypes)), UPDATED).otherwise(KEPT)
    )
    joined = d.join(s, on, "full_outer").withColumn("_action", action)
    new, take = F.col("_action") == INSERTED, F.col("_action") != KEPT
    matched = joined.select(
        F.col("d.dw_id").alias("dw_id"),
        *[F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in spec.columns],
        F.when(new, stamp).otherwise(F.col("d.dw_last_inserted")).alias("dw_last_inserted"),
        F.when(take, stamp).otherwise(F.col("d.dw_last_updated")).alias("dw_last_updated"),
        "_action",
    )
    old_keyless = dw.filter(~_has_key(keys)).select(
        "dw_id", *spec.columns, "dw_last_inserted", "dw_last_updated", F.lit(KEPT).alias("_action"))
    new_keyless = stg.filter(~_has_key(keys)).select(
        F.lit(None).cast("bigint").alias("dw_id"), *spec.columns, stamp.alias("dw_last_inserted"),
        stamp.alias("dw_last_updated"), F.lit(INSERTED).alias("_action"))
    return matched.unionByName(old_keyless).unionByName(new_keyless)


def _checked_profile(dw: DataFrame, stg: DataFrame, spec: MergeSpec, on_duplicate: str) -> KeyProfile:
    profile = key_profile(dw, stg, spec.keys)
    if profile.ambiguous and on_duplicate == "error":
        raise AmbiguousSource(f"{profile.ambiguous} repeated snapshot key(s) match an existing row: {spec.keys}")
    return profile


def _highest(dw: DataFrame) -> int:
    return dw.agg(F.coalesce(F.max("dw_id"), F.lit(0))).first()[0]


def _numbered(rows: DataFrame, spec: MergeSpec, highest: int, folder: str) -> DataFrame:
    """Surrogate keys in key order; rows that repeat a key go by their other columns, so that a rerun numbers alike."""
    order = [*spec.keys, *[c for c in spec.columns if c not in spec.keys]]
    return number_rows(rows, order, "dw_id", highest, f"{folder}/numbered")


def merge(dw: DataFrame, stg: DataFrame, spec: MergeSpec, run_ts: datetime, *, on_duplicate: str = "error",
          folder: str | None = None) -> DataFrame:
    """The warehouse table after the merge, plus `_action` (insert, update, keep).

    `on_duplicate`: "error" raises AmbiguousSource when a repeated snapshot key
    matches an existing row; "keep" leaves such a warehouse row as it is.
    New rows get surrogate keys after the highest one, in key order; `folder`
    is where they are written for that (see number_rows).
    """
    profile = _checked_profile(dw, stg, spec, on_duplicate)
    folder = folder or new_folder(dw.sparkSession, "numbering")
    fresh = new_rows(dw, stg, spec, run_ts)
    fresh.write.parquet(f"{folder}/new")  # the numbering looks at its rows twice, the join is made once
    saved = dw.sparkSession.read.schema(fresh.schema).parquet(f"{folder}/new")
    numbered = _numbered(saved, spec, _highest(dw), folder)
    return existing_rows(dw, stg, spec, run_ts, profile).unionByName(numbered)


# --- tables kept in parts by surrogate key, with a stored hash of the compared columns

HASH = "_row_hash"  # in the files only, not in a table's layout
PART_ROWS = 1_000_000  # surrogate keys of one part
_PART = r"([^/]+/[^/]+/_part=[0-9]+)(?:/[^/]*)?$"  # what tells a part's folder from any other


def _hashed(spec: MergeSpec) -> str | None:
    """What a row's hash is made of; None where every match is an update."""
    return None if spec.compare is None else json.dumps([list(spec.compare), spec.sentinels])


def row_hash(spec: MergeSpec, types: dict[str, str]) -> Column:
    """Of the compared columns; nulls count by their place."""
    if spec.sentinels:
        return F.xxhash64(*[F.coalesce(F.col(c), _stand_in(types[c])) for c in spec.compare])
    return F.xxhash64(*[x for c in spec.compare for x in (F.col(c), F.col(c).isNull())])


def _written_in_parts(rows: DataFrame, spec: MergeSpec, folder: str, part_rows: int) -> list[str]:
    """Write warehouse rows into a folder per `part_rows` surrogate keys; the folders that came."""
    if spec.compare is not None:
        rows = rows.withColumn(HASH, row_hash(spec, dict(rows.dtypes)))
    rows.withColumn("_part", F.floor((F.col("dw_id") - 1) / part_rows)).write.partitionBy("_part").parquet(folder)
    return [f"{folder}/{name}" for name in Files(rows.sparkSession).names(folder) if name.startswith("_part=")]


def _merge_parts(store: Store, name: str, stg: DataFrame, spec: MergeSpec, run_ts: datetime, part_rows: int) -> dict[str, int]:
    """The merge of unique keys into a table kept in parts.

    Keys and hashes meet first, so nothing else of an unchanged row is shuffled.
    Whole rows are fetched for the keys that are new or changed; parts that hold
    a changed row are written anew, all others stay the files they are.
    """
    before, (version, folder) = store.newest(name), store.next_folder(name)
    spark, keys, stamp = store.spark, list(spec.keys), run_stamp(run_ts)
    layout = StructType.fromJson(json.loads(before.layout))
    types = {f.name: f.dataType for f in layout}
    with_hash = StructType([*layout.fields, StructField(HASH, LongType())])
    staged = stg.select(*[F.col(c).cast(types[c]).alias(c) for c in spec.columns])
    hashes = staged.filter(_has_key(keys)).select(*keys, row_hash(spec, dict(staged.dtypes)).alias("_new"))
    stored = spark.read.schema(with_hash).parquet(*before.parts)
    known = stored.filter(_has_key(keys)).select(*keys, "dw_id", F.col(HASH).alias("_old"), F.regexp_extract("_metadata.file_path", _PART, 1).alias("_part"))
    action = F.when(F.col("dw_id").isNull(), INSERTED).when(F.col("_old") != F.col("_new"), UPDATED)
    scratch = store.scratch("changes")
    found = hashes.join(known, keys, "left").withColumn("_action", action).filter("_action is not null").select(*keys, "dw_id", "_part", "_action")
    found.write.parquet(f"{scratch}/keys")
    changes = spark.read.schema(found.schema).parquet(f"{scratch}/keys")
    tally = {(r["_action"], r["_part"]): r["n"] for r in changes.groupBy("_action", "_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per part
    total = stored.count()  # from the files' footers
    touched = {p for a, p in tally if a == UPDATED}
    parts = [p for p in before.parts if re.search(_PART, p)[1] not in touched]

    if touched:
        new = staged.join(changes.filter(F.col("_action") == UPDATED).select(*keys, "dw_id"), keys).alias("s")
        old = spark.read.schema(with_hash).parquet(*[p for p in before.parts if p not in parts]).alias("d")
        take = F.col("s.dw_id").isNotNull()
        rewritten = old.join(new, F.col("d.dw_id") == F.col("s.dw_id"), "left").select(
            F.col("d.dw_id").alias("dw_id"), *[F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in spec.columns],
            F.col("d.dw_last_inserted").alias("dw_last_inserted"), F.when(take, stamp).otherwise(F.col("d.dw_last_updated")).alias("dw_last_updated"))
        by_part = rewritten.repartition(F.floor((F.col("dw_id") - 1) / part_rows))
        parts += _written_in_parts(by_part, spec, f"{folder}/rows", part_rows)
    inserted = sum(n for (a, _), n in tally.items() if a == INSERTED)
    keyless, added = staged.filter(~_has_key(keys)), []
    if inserted or not keyless.isEmpty():
        fresh = staged.join(changes.filter(F.col("_action") == INSERTED).select(*keys), keys, "left_semi").select(*spec.columns)
        rows = fresh.unionByName(keyless).withColumns({"dw_last_inserted": stamp, "dw_last_updated": stamp})
        numbered = _numbered(rows, spec, before.highest, scratch).select(*layout.names)
        added = _written_in_parts(numbered, spec, f"{folder}/new", part_rows)
        inserted = spark.read.schema(layout).parquet(*added).count()
    updated = sum(n for (a, _), n in tally.items() if a == UPDATED)
    store.commit(name, version, [*parts, *added], before.layout, keys_unique=True, highest=before.highest + inserted, hashed=before.hashed)
    store.discard(scratch)
    return {"inserted": inserted, "updated": updated, "kept": total - updated}


def counters(dw: DataFrame, run_ts: datetime) -> DataFrame:
    """Rows inserted, updated and left alone by the run, read off the audit stamps."""
    stamp = run_stamp(run_ts)
    inserted = F.col("dw_last_inserted") == stamp
    updated = (F.col("dw_last_updated") == stamp) & (F.col("dw_last_updated") > F.col("dw_last_inserted"))
    counts = dw.agg(F.count_if(inserted).alias("inserted"), F.count_if(updated).alias("updated"), F.count(F.lit(1)).alias("total"))
    return counts.select("inserted", "updated", (F.col("total") - F.col("inserted") - F.col("updated")).alias("kept"))


def empty_warehouse(stg: DataFrame, spec: MergeSpec) -> DataFrame:
    """No rows yet, in the layout of the warehouse table."""
    staged = [(f.name, f.dataType.simpleString()) for f in stg.select(*spec.columns).schema]
    audit = [tuple(c.split()) for c in AUDIT.split(", ")]
    return stg.sparkSession.range(0).select(
        *[F.lit(None).cast(t).alias(n) for n, t in [audit[0], *staged, *audit[1:]]])


def merge_table(store: Store, name: str, stg: DataFrame, spec: MergeSpec, run_ts: datetime, *,
                on_duplicate: str = "error", part_rows: int = PART_ROWS) -> dict[str, int]:
    """Merge a staged snapshot into warehouse table `name` and commit the new version.

    Returns the rows inserted, updated and kept. With a change test, a table is
    kept in parts of `part_rows` surrogate keys, and a merge writes only those
    that hold a changed row.
    """
    dw = store.read(name)
    if dw is None:
        return _first_load(store, name, stg, spec, run_ts, part_rows)
    if store.keys_unique(name):  # the warehouse keys need no look then
        unique = not repeats(stg, spec.keys)
    else:
        profile = _checked_profile(dw, stg, spec, on_duplicate)
        unique = not (profile.repeated_in_source or profile.repeated_in_target)
    if unique:
        newest = store.newest(name)
        in_parts = newest.hashed is not None and newest.hashed == _hashed(spec) and newest.highest is not None
        return (_merge_parts(store, name, stg, spec, run_ts, part_rows) if in_parts
                else _merge_unique(store, name, dw, stg, spec, run_ts))
    folder = store.scratch("numbering")
    merged = merge(dw, stg, spec, run_ts, on_duplicate=on_duplicate, folder=folder)
    number, place = store.next_folder(name)
    merged.drop("_action").write.parquet(place)
    written = store.commit(name, number, [place], merged.drop("_action").schema.json())
    store.discard(folder)
    return counters(written, run_ts).first().asDict()


def _first_load(store: Store, name: str, stg: DataFrame, spec: MergeSpec, run_ts: datetime, part_rows: int) -> dict[str, int]:
    dw = empty_warehouse(stg, spec)
    folder = store.scratch("numbering")
    rows = _numbered(new_rows(dw, stg, spec, run_ts), spec, 0, folder).select(dw.columns)
    number, place = store.next_folder(name)
    parts = _written_in_parts(rows, spec, f"{place}/rows", part_rows)
    n = store.spark.read.schema(rows.schema).parquet(*parts).count() if parts else 0
    if not parts:  # an empty table has a folder all the same
        rows.limit(0).write.parquet(f"{place}/empty")
    unique = not repeats(stg, spec.keys)
    store.commit(name, number, parts or [f"{place}/empty"], rows.schema.json(), keys_unique=unique, highest=n,
                 hashed=_hashed(spec) if parts else None)
    store.discard(folder)
    return {"inserted": n, "updated": 0, "kept": 0}


def _merge_unique(store: Store, name: str, dw: DataFrame, stg: DataFrame, spec: MergeSpec, run_ts: datetime) -> dict[str, int]:
    """The merge of unique keys: one join, one write, and only the new rows are written again with their numbers."""
    before, (version, folder) = store.newest(name), store.next_folder(name)
    rows = outer_rows(dw, stg, spec, run_ts)
    layout = rows.drop("_action").schema
    rows.write.partitionBy("_action").parquet(f"{folder}/rows")
    written = store.spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    counts = {r["_action"]: r["count"] for r in written.groupBy("_action").count().collect()}  # at most three rows
    parts = [f"{folder}/rows/_action={a}" for a in (KEPT, UPDATED) if counts.get(a)]
    highest = before.highest if before and before.highest is not None else _highest(dw)  # rows are never taken out
    if counts.get(INSERTED) or not parts:
        scratch = store.scratch("numbering")
        fresh = written.filter(F.col("_action") == INSERTED).drop("dw_id", "_action")
        numbered = _numbered(fresh, spec, highest, scratch)
        numbered.select(*layout.names).write.parquet(f"{folder}/new")
        store.discard(scratch)
        parts.append(f"{folder}/new")
    store.commit(name, version, parts, layout.json(), keys_unique=True, highest=highest + counts.get(INSERTED, 0))
    return {"inserted": counts.get(INSERTED, 0), "updated": counts.get(UPDATED, 0), "kept": counts.get(KEPT, 0)}


def run_all(store: Store, staged: dict[str, tuple[DataFrame, MergeSpec]], run_ts: datetime, *, at_a_time: int = 4) -> DataFrame:
    """Merge every staged table; tables are independent and run a few at a time.

    Once one fails no further table is started, and the failure is raised.
    Returns one row per table: inserted, updated, kept.
    """
    names, results, failed = list(staged), {}, []

    def one(name):
        if failed:
            return
        try:
            results[name] = merge_table(store, name, *staged[name], run_ts)
        except Exception as e:
            failed.append(name)
            raise RuntimeError(f"merge of {name} failed") from e

    with ThreadPoolExecutor(max_workers=at_a_time) as pool:
        jobs = [pool.submit(one, n) for n in names]
    for job in jobs:
        job.result()
    rows = [(n, results[n]["inserted"], results[n]["updated"], results[n]["kept"]) for n in names]
    return store.spark.createDataFrame(rows, "table_name string, inserted bigint, updated bigint, kept bigint")


def warehouse_tables(store: Store, names: list[str]) -> dict[str, DataFrame]:
    """Current versions of several warehouse tables."""
    return {n: df for n in names if (df := store.read(n)) is not None}
