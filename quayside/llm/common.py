"""What the operators of this subpackage share."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayside.session import configure, new_folder, sent_with_jobs
from quayside.storage import Files

sent_with_jobs(__name__)

# a word is a run of anything but these blanks
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")


_made: ContextVar[list[str] | None] = ContextVar("folders", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Folders that `saved` makes inside are removed at the end, but for those taken out of the list."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        files = Files(spark)
        for folder in made:
            files.delete(folder)


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here and a lost executor recomputes nothing before it."""
    folder = new_folder(df.sparkSession, name)
    made = _made.get()
    if made is not None:
        made.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_of(column: str = "text") -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def key_of(id: str = "doc_id", text: str = "text") -> Column:
    """A row's own hash, alike only for rows that repeat id and text."""
    return F.xxhash64(F.coalesce(F.col(id).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit("")))


def bound(value: Column, body) -> Column:
    """body(x) with x = value, computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def appended(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """`schema` with `fields` at its end; a column of the same name gives way."""
    new = {f.name for f in fields}
    return T.StructType([*[f for f in schema.fields if f.name not in new], *fields])


def with_arrays(batch, schema_names: list[str], arrays: dict):
    """An Arrow record batch with `arrays` put in under their names."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [arrays[n] if n in arrays else batch.column(batch.schema.get_field_index(n)) for n in schema_names], names=schema_names)


def slices(batches, text: str, chars: int = 1 << 20):
    """Arrow batches cut so that each holds about `chars` bytes of text, or one longer text."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes, dtype=np.int64) if len(sizes) else np.zeros(0, np.int64)
        start = 0
        while start < len(sizes):
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + chars, side="right")))
            yield batch.slice(start, end - start)
            start = end


def summed(vectors: DataFrame, tasks: int = 8):
    """The sum of binary float64 vectors of one length, a column named `sums`; tasks add them up before the driver sees one. None without rows."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            for raw in batch.column(0):
                own = np.frombuffer(raw.as_buffer(), np.float64)
                total = own.copy() if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    for n in (tasks, 1):
        vectors = vectors.select("sums").repartition(n).mapInArrow(run, "sums binary")
    found = vectors.first()
    return None if found is None else np.frombuffer(found.sums, np.float64)
