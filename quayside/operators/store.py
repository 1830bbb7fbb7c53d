"""Versioned Parquet tables: a write never touches the version being read.

A table is a folder per version plus one small file per committed version that
names its parts; a version counts once its file is there. The file is created
under the version's number and only if there is none, so of two writers one
gets the number and the other is told. A failed or retried job leaves an
unlisted folder behind and nothing else. Finding a version takes a listing and
no Spark job; `expire` removes what no kept version names.

A snapshot is a file of the same kind that names the versions of several tables
which belong together: who reads by snapshot never sees some tables of a run and
not yet the others. A version can be read by its number, by its time or by a
snapshot, and two versions can be compared by what only one of them names.

"Only if there is none" needs a file system that creates files atomically: HDFS
and local ones do. On object stores a check and a put are two steps, so a root
there is refused unless `locks` names a folder on a file system that can; the
number is claimed there first.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from quayside.storage import Files


class VersionTaken(RuntimeError):
    """Another writer has committed this version number."""


@dataclass(frozen=True)
class Version:
    number: int
    parts: list[str]
    layout: str  # JSON of the schema; serves versions without a single row too
    keys_unique: bool | None
    highest: int | None  # of the surrogate keys, where there are any
    at: str | None = None  # when it was committed, UTC
    hashed: str | None = None  # what the rows' stored hash is made of, where there is one


ATOMIC = ("", "file", "hdfs", "viewfs", "abfs", "abfss")  # fixed values: schemes of file systems that create a file once
SNAPSHOTS = "_snapshots"


class Store:
    def __init__(self, spark: SparkSession, root: str, locks: str | None = None):
        self.spark, self.root, self.files, self.locks = spark, root.rstrip("/"), Files(spark), locks and locks.rstrip("/")
        scheme = root.split("://")[0] if "://" in root else root.split(":")[0] if root.startswith("file:") else ""
        if scheme not in ATOMIC and not locks:
            raise ValueError(f"{scheme} does not create files atomically: name a folder for locks on a file system that does")

    def _log(self, name: str) -> str:
        return f"{self.root}/_versions/{name}"

    def _entry(self, name: str, number: int) -> str:
        return f"{self._log(name)}/{number:012d}.json"

    def _numbers(self, name: str) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(self._log(name)) if n.endswith(".json") and n[0] != "."]

    def _read_entry(self, name: str, number: int) -> Version | None:
        """None for a file whose writer died before it was full."""
        try:
            return Version(number, **json.loads(self.files.read(self._entry(name, number))))
        except ValueError:
            return None

    def _create(self, entry: str, text: str) -> bool:
        """Write an entry; False if another writer has its number."""
        if self.locks and not self.files.create(f"{self.locks}/{entry.removeprefix(self.root).strip('/').replace('/', '-')}", ""):
            return False
        return self.files.create(entry, text)

    def newest(self, name: str) -> Version | None:
        return next((v for n in reversed(self._numbers(name)) if (v := self._read_entry(name, n))), None)

    def _open(self, version: Version) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(version.layout))).parquet(*version.parts)

    def version(self, name: str) -> int:
        """Number of the newest committed version; 0 when there is none."""
        newest = self.newest(name)
        return newest.number if newest else 0

    def find(self, name: str, as_of: int | datetime | None = None) -> Version | None:
        """The newest version, that of a number, or the newest one committed by a time (UTC unless it has a zone)."""
        if as_of is None:
            return self.newest(name)
        if isinstance(as_of, int):
            return self._read_entry(name, as_of) if as_of in self._numbers(name) else None
        limit = _utc(as_of)
        return next((v for n in reversed(self._numbers(name)) if (v := self._read_entry(name, n)) and v.at and v.at <= limit), None)

    def read(self, name: str, as_of: int | datetime | None = None) -> DataFrame | None:
        found = self.find(name, as_of)
        return self._open(found) if found else None

    def commit_together(self, versions: dict[str, int]) -> int:
        """Make versions of several tables one snapshot; its number."""
        while True:
            number = max(self._numbers(SNAPSHOTS), default=0) + 1
            if self._create(self._entry(SNAPSHOTS, number), json.dumps({"tables": versions, "at": _utc(datetime.now(timezone.utc))})):
                return number

    def snapshot(self, names: list[str]) -> int:
        """The newest versions of some tables as one snapshot; tables without a version are left out."""
        return self.commit_together({n: v for n in names if (v := self.version(n))})

    def read_together(self, number: int | None = None) -> dict[str, DataFrame]:
        """The tables of a snapshot, the newest one if no number is given; none if there is no snapshot."""
        numbers = self._numbers(SNAPSHOTS)
        for n in reversed(numbers if number is None else [number] if number in numbers else []):
            try:
                tables = json.loads(self.files.read(self._entry(SNAPSHOTS, n)))["tables"]
            except ValueError:  # its writer died before it was full
                continue
            return {name: self.read(name, version) for name, version in tables.items()}
        return {}

    def changes_between(self, name: str, old: int, new: int, keys: list[str]) -> DataFrame:
        """Rows that two versions do not share: the newer one's columns (the older one's of deleted rows) and `_change`
        (insert, update, delete). `keys` are unique in each; rows are compared without regard to nulls' kind.

        What both versions name is not read.
        """
        before, after = self.find(name, old), self.find(name, new)
        columns = StructType.fromJson(json.loads(after.layout)).names

        def only(of: Version, other: Version) -> DataFrame:
            parts = [p for p in of.parts if p not in other.parts]
            return self._open(Version(of.number, parts, of.layout, None, None)) if parts else self._open(of).limit(0)

        def hashed(rows: DataFrame, prefix: str) -> DataFrame:
            rest = [c for c in columns if c not in keys]
            return rows.select(F.struct(*keys).alias("key"), F.xxhash64(*[x for c in rest for x in (F.col(c), F.col(c).isNull())]).alias(f"{prefix}_hash"))

        # keys and hashes first, whole rows of the keys that differ
        left, right = only(before, after), only(after, before)
        both = hashed(left, "old").join(hashed(right, "new"), "key", "full_outer")
        change = F.when(F.col("old_hash").isNull(), "insert").when(F.col("new_hash").isNull(), "delete").when(
            F.col("old_hash") != F.col("new_hash"), "update")
        differing = both.select("key", change.alias("_change")).filter("_change is not null")
        whole = lambda rows, kept: rows.withColumn("key", F.struct(*keys)).join(differing.filter(kept), "key").select(*columns, "_change")
        return whole(right, "_change <> 'delete'").unionByName(whole(left, "_change = 'delete'"))

    def keys_unique(self, name: str) -> bool:
        """Is it on record that the newest version repeats no business key?"""
        newest = self.newest(name)
        return bool(newest and newest.keys_unique)

    def next_folder(self, name: str) -> tuple[int, str]:
        """(number, fresh folder) for the next version."""
        number = max(self._numbers(name), default=0) + 1
        return number, f"{self.root}/{name}/v{number:06d}-{uuid.uuid4().hex[:8]}"

    def scratch(self, name: str) -> str:
        """A fresh folder for intermediate rows, on the same shared storage as the tables."""
        return f"{self.root}/_scratch/quayside/{name}-{uuid.uuid4().hex}"

    def commit(self, name: str, number: int, parts: list[str], layout: str, *, keys_unique: bool | None = None,
               highest: int | None = None, hashed: str | None = None) -> DataFrame:
        """Make the folders `parts` the given version of the table; VersionTaken if another writer was first."""
        entry = {"parts": parts, "layout": layout, "keys_unique": keys_unique, "highest": highest, "hashed": hashed,
                 "at": _utc(datetime.now(timezone.utc))}
        if not self._create(self._entry(name, number), json.dumps(entry)):
            raise VersionTaken(f"{name}: version {number} was committed by another writer")
        return self._open(Version(number, **entry))

    def prepare(self, name: str, df: DataFrame, *, partition_by: tuple[str, ...] = ()) -> tuple[str, DataFrame]:
        """Write `df` into a fresh folder of the table, not yet committed: (folder, the rows read back)."""
        _, folder = self.next_folder(name)
        writer = df.write.mode("error")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        return folder, self.spark.read.schema(df.schema).parquet(folder)

    def commit_whole(self, name: str, folder: str, layout: str, *, keys_unique: bool | None = None,
                     highest: int | None = None) -> DataFrame:
        """Make `folder` the whole table under the next free number: it does not build on what it replaces."""
        while True:
            number, _ = self.next_folder(name)
            try:
                return self.commit(name, number, [folder], layout, keys_unique=keys_unique, highest=highest)
            except VersionTaken:
                continue

    def write(self, name: str, df: DataFrame, *, partition_by: tuple[str, ...] = (), keys_unique: bool | None = None,
              highest: int | None = None) -> DataFrame:
        """Write `df` as the next version, commit it and return it as read back."""
        folder, _ = self.prepare(name, df, partition_by=partition_by)
        return self.commit_whole(name, folder, df.schema.json(), keys_unique=keys_unique, highest=highest)

    def discard(self, folder: str) -> None:
        """Remove a folder that no version names."""
        self.files.delete(folder)

    def expire(self, name: str, keep: int = 2) -> list[int]:
        """Remove all but the newest `keep` versions and the folders only they name; returns the numbers removed."""
        known = [(n, self._read_entry(name, n)) for n in self._numbers(name)]
        kept = [v for _, v in known if v][-max(1, keep):]
        used = {part for v in kept for part in v.parts}
        old = [(n, v) for n, v in known if n < kept[0].number] if kept else []
        for number, version in old:
            self.files.delete(self._entry(name, number))  # first the claim, then what it claims
            for part in version.parts if version else []:
                if part not in used:
                    self.files.delete(part)
        return [n for n, _ in old]


def _utc(at: datetime) -> str:
    """A time as text that sorts by time."""
    return (at if at.tzinfo is None else at.astimezone(timezone.utc).replace(tzinfo=None)).isoformat(sep=" ", timespec="microseconds")
