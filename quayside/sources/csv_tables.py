"""CSV tables addressed by header name."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quayside.session import sent_with_jobs
from quayside.sources.files import open_seekable
from quayside.sources.ranges import RANGE, record_ends, records

sent_with_jobs(__name__)


def header_key(name: str) -> str:
    """Header names match without regard to case and punctuation: Pier_Id is pier_id."""
    return re.sub(r"[^a-z0-9]", "", name.lower())


def places(names: list[str], wanted: list[str]) -> list[int | None]:
    """Where each wanted header stands among `names`: the very name if it is there, else the last one alike."""
    exact, alike = {n: i for i, n in enumerate(names)}, {header_key(n): i for i, n in enumerate(names)}
    return [exact.get(w, alike.get(header_key(w))) for w in wanted]


# a field behind its comma; possessive, so long texts cost no stack and no second try
FIELD = r'(?s),("(?:[^"]++|"")*+"|[^,]*+)'


def fields_of(record: Column) -> Column:
    """The fields of a CSV record, its line feed included or not: quoted fields without their quotes, doubled quotes once."""
    found = F.regexp_extract_all(F.concat(F.lit(","), F.regexp_replace(record, r"\r?\n?\z", "")), F.lit(FIELD), F.lit(1))
    return F.transform(found, lambda f: F.when(f.startswith('"'), F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))


def names_of(record: str) -> list[str]:
    """The fields of a header."""
    found = re.findall(r',("(?:[^"]+|"")*"|[^,]*)', "," + record.rstrip("\r\n"), re.S)
    return [f[1:-1].replace('""', '"') if f.startswith('"') else f for f in found]


def _distinct(names: list[str]) -> list[str]:
    """Names that a table can have: without one, the column's number; of several alike, each with its number."""
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_csv(spark: SparkSession, path: str, *, embedded_newlines: bool = True, range_bytes: int = RANGE) -> DataFrame:
    """All columns as text: quoted fields, doubled quotes, newlines in quotes; empty is NULL.

    Files whose fields hold newlines are cut into ranges that many tasks read
    (see `ranges`); pass embedded_newlines=False for plain files, which Spark
    splits by itself. The first file's header names the columns.
    """
    options = {"quote": '"', "escape": '"'}
    if not embedded_newlines:
        return spark.read.options(**options, header=True).csv(path)
    first = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0").orderBy("path").first()
    names = _distinct(names_of(_first_record(first.path, first.length))) if first else []
    if not names:
        return spark.createDataFrame([], "value string").select()
    rows = records(spark, path, "csv", range_bytes, head=True).filter(~F.col("record").rlike(r"\A\s*\z"))
    places = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    parsed = rows.select(F.from_csv(F.regexp_replace("record", r"\r?\n\z", ""), places.simpleString()[7:-1].replace(":", " "), {**options, "multiLine": "true"}).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])


def _first_record(path: str, size: int) -> str:
    with open_seekable(path) as file:
        data = b""
        while len(data) < size:
            data += file.read(1 << 16)
            ends, _ = record_ends(data, 0)
            if len(ends):
                data = data[:int(ends[0])]
                break
    return data.removeprefix(b"\xef\xbb\xbf").decode(errors="replace")


def by_header(raw: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Columns of `raw` picked by header name ({output: header}); missing ones NULL, others ignored."""
    at = places(raw.columns, list(wanted.values()))
    return raw.select(*[
        (F.lit(None).cast("string") if i is None else F.col(f"`{raw.columns[i]}`")).alias(out) for out, i in zip(wanted, at)])
