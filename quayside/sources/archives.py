"""Snapshot archives: pick the newest one, fan its CSV members out to tasks."""

from __future__ import annotations

import tarfile
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayside.operators.spread import shuffle_partitions
from quayside.session import sent_with_jobs
from quayside.sources.csv_tables import fields_of, names_of, places
from quayside.sources.files import open_seekable
from quayside.sources.ranges import record_ends, texts

sent_with_jobs(__name__)

_CHUNK = 1 << 20
HEADER = -1  # record_no of a member's header
RECORD = "path string, member string, table_name string, record_no bigint, record string, at array<int>"
MEMBER = "path string, member string, table_name string, size bigint"


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """path, modificationTime and length of every file below `folder`; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", "modificationTime", "length")
    )


def latest_archive(listing: DataFrame, suffix: str, *, ignore_case: bool) -> DataFrame:
    """The newest file with the suffix, as one row or none; the first path wins a tie."""
    path = F.lower("path") if ignore_case else F.col("path")
    wanted = path.endswith(suffix.lower() if ignore_case else suffix)
    return listing.filter(wanted).orderBy(F.desc("modificationTime"), "path").limit(1)


def _base(member: str) -> str:
    return member.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def _landed(stream, path: str, member: str, table: str, headers: list[str], on_bad_utf8: str):
    """Arrow batches of a member's records as they stand in it, its own header first; only quotes and line feeds are looked at.

    `at` says where the wanted headers stand in a record.
    """
    import numpy as np
    import pyarrow as pa

    on_bad, held, inside, no, at = "ignore" if on_bad_utf8 == "drop" else "fail", [], 0, HEADER, None
    while True:
        chunk = stream.read(_CHUNK)
        if chunk:
            ends, inside = record_ends(chunk, inside)
            if not len(ends):
                held.append(chunk)
                continue
            cut = int(ends[-1])
            data, ends = b"".join([*held, chunk[:cut]]), (ends + sum(map(len, held))).tolist()
            held = [chunk[cut:]]
        else:
            data, held = b"".join(held), []
            ends = [len(data)] if data else []
        found = texts(data, ends, on_bad)
        if at is None and (len(found) or not chunk):
            names = names_of(found[0].as_py().removeprefix("\ufeff")) if len(found) else []
            at = places(names, headers)
            yield _batch(path, member, table, HEADER, found[:1] if len(found) else pa.array([""]), list(range(len(names))))
            found, no = found[1:], 0
        # blank lines are no records
        found = found.filter(pa.array([t not in ("\n", "\r\n", "") for t in found.to_pylist()], pa.bool_()))
        if len(found):
            yield _batch(path, member, table, no, found, at)
            no += len(found)
        if not chunk:
            return


def _batch(path, member, table, no, found, at):
    import numpy as np
    import pyarrow as pa

    n = len(found)
    same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
    return pa.RecordBatch.from_arrays([
        same(path, pa.string()), same(member, pa.string()), same(table, pa.string()), pa.array(np.arange(no, no + n)), found,
        same(at, pa.list_(pa.int32()))], names=[c.split(" ")[0] for c in RECORD.split(", ")])


def _csv_entries(path: str) -> list[zipfile.ZipInfo]:
    with open_seekable(path) as raw, zipfile.ZipFile(raw) as z:
        return [i for i in z.infolist() if i.filename.lower().endswith(".csv")]


def _members(path: str, entries) -> pd.DataFrame:
    rows = [(path, i.filename, _base(i.filename), i.file_size) for i in entries]
    return pd.DataFrame(rows, columns=["path", "member", "table_name", "size"])


def zip_members(archives: DataFrame, tables: list[str]) -> DataFrame:
    """CSV members on the list, from the archives' directories alone; of equal base names the last counts."""
    allowed = set(tables)

    def listed(frames):
        for frame in frames:
            for path in frame["path"]:
                last = {_base(i.filename): i for i in _csv_entries(path)}
                yield _members(path, [i for t, i in last.items() if t in allowed])

    return archives.select("path").mapInPandas(listed, MEMBER)


def skipped_members(archives: DataFrame, tables: list[str]) -> DataFrame:
    """CSV members no table of the list reads."""
    allowed = set(tables)

    def skipped(frames):
        for frame in frames:
            for path in frame["path"]:
                yield _members(path, [i for i in _csv_entries(path) if _base(i.filename) not in allowed])

    return archives.select("path").mapInPandas(skipped, MEMBER)


def zip_records(archives: DataFrame, columns: dict[str, list[str]], *, on_bad_utf8: str = "fail") -> DataFrame:
    """CSV records of the listed members: {table: [header, ...]} fixes which fields come, in which order.

    Members are dealt out to tasks one by one; a task seeks to its member,
    inflates it and cuts it where records end, so neither an archive nor a
    member is ever held whole. Fields are taken apart later, by as many tasks as
    read the records (`rows_of`, `one_table`). Each member's own header comes
    along as record HEADER, also of one without rows.
    """

    def unpacked(batches):
        for batch in batches:
            for path, member, table in zip(*(c.to_pylist() for c in batch.columns)):
                with open_seekable(path) as raw, zipfile.ZipFile(raw) as z, z.open(member) as stream:
                    yield from _landed(stream, path, member, table, columns[table], on_bad_utf8)

    # a fixed number of tasks: members look tiny as listed, and AQE would put them all into one
    members = zip_members(archives, list(columns)).repartition(shuffle_partitions(archives))
    return members.select("path", "member", "table_name").mapInArrow(unpacked, RECORD)


def tar_records(archives: DataFrame, columns: dict[str, list[str]], *, folder: str = "data",
                on_bad_utf8: str = "drop") -> DataFrame:
    """CSV records of the members <folder>/<table>.csv of gzipped tar archives.

    Such an archive can only be read from front to back, so one task streams it
    once for all its tables; archives are independent of each other.
    """
    wanted = {f"{folder}/{t}.csv": t for t in columns}

    def unpacked(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_seekable(path) as raw, tarfile.open(fileobj=raw, mode="r:gz") as tar:
                    for entry in tar:
                        table = wanted.get(entry.name.removeprefix("./"))
                        if table and entry.isfile():
                            yield from _landed(tar.extractfile(entry), path, entry.name, table, columns[table], on_bad_utf8)

    return archives.select("path").repartition(shuffle_partitions(archives)).mapInArrow(unpacked, RECORD)


def _fields() -> Column:
    """The wanted fields of a record, in order; of a header all."""
    return F.element_at(F.transform(F.array(fields_of(F.col("record"))), lambda own: F.transform("at", lambda i: F.get(own, i))), 1)


def rows_of(records: DataFrame) -> DataFrame:
    """Without the headers, taken apart: path, member, table_name, record_no, fields."""
    return records.filter(F.col("record_no") > HEADER).select("path", "member", "table_name", "record_no", _fields().alias("fields"))


def found_members(records: DataFrame) -> DataFrame:
    """Members that came out of the archives, with their own headers (`fields`), rows or none."""
    return records.filter(F.col("record_no") == HEADER).select("path", "member", "table_name", _fields().alias("fields"))


def missing_tables(records: DataFrame, expected: list[str]) -> DataFrame:
    """Expected tables without a member."""
    names = records.sparkSession.createDataFrame([(t,) for t in expected], "table_name string")
    return names.join(found_members(records).select("table_name").distinct(), "table_name", "left_anti")


def one_table(records: DataFrame, table: str, headers: list[str], present: list[str] | None = None) -> DataFrame:
    """Records of one table as text columns named by their headers; empty is NULL.

    With the file's own header as `present`, columns it does not have are left out.
    """
    at = places(present, headers) if present is not None else [0] * len(headers)
    fields = [F.nullif(F.col("fields")[i], F.lit("")).alias(h) for i, h in enumerate(headers) if at[i] is not None]
    return rows_of(records.filter(F.col("table_name") == table)).select(*fields)


def land(records: DataFrame, folder: str, *, records_per_file: int = 2_000_000) -> DataFrame:
    """Write unpacked records once, split by table, so that each table is then read on its own and in parallel."""
    records.write.option("maxRecordsPerFile", records_per_file).partitionBy("table_name").parquet(folder)
    return records.sparkSession.read.schema(records.schema).parquet(folder)
