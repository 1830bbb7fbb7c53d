"""Vectors as short codes of learned parts, by dictionaries of the values of each dimension.

A component becomes the integer floor(256 x). Vectors are cut into equal parts,
and each part position has a codebook, which rounds of assigning and averaging
improve from the parts of the first vectors. All arithmetic is of integers, so
results do not depend on how rows are spread.

Vectors are packed once into blocks of `BLOCK` rows. A block holds, for each
dimension, a dictionary of its distinct integers and each row's place in it. A
pass tabulates, for each dimension, the squared differences of every distinct
integer to all codebook entries; a part's distances are then gathers and adds
over the places. Dictionaries belong to their block, so a table has `BLOCK`
rows at most whatever the values are. Sums and counts of entries are added up
in the task before they are shuffled; the driver sees the codebooks alone.

Defined results: vectors that are null, hold null or non-finite components, are
empty, of another length than most, or do not cut into equal parts take no
part; components beyond 2 ** 20 either way count as that, so that no sum
overflows; a null id comes last and is coded like any other; rows that repeat
an id start the codebooks in the order of their vectors, then of their labels,
and each count; with fewer vectors than entries the codebooks are shorter;
null labels are one label; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import read, saved
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = SCALE << 20  # of a component
BLOCK = 8192  # vectors


def integers(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS) -> DataFrame:
    """vec_id, label and v (integers) of the usable vectors."""
    v = F.col(vector).cast("array<double>")
    usable = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("x")).filter(
        F.col("x").isNotNull() & (F.size("x") > 0) & (F.size("x") % parts == 0) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (
            F.abs(c) < float("inf"))))
    sizes = usable.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    scaled = lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.greatest(
        F.lit(-2.0 * LARGEST), F.least(F.lit(2.0 * LARGEST), c * SCALE))))).cast("int")
    return usable.filter(F.size("x") == (sizes.size if sizes else 0)).select("vec_id", "label", F.transform("x", scaled).alias("v"))


def packed(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of `rows` (vec_id, label, v): ids, labels, places in each dimension's dictionary (dimension by dimension), dictionaries and their ends."""
    label = rows.schema["label"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def one(rows):
            grid = np.concatenate([c.flatten().to_numpy() for c in rows.column(2).chunks]).reshape(rows.num_rows, -1)
            places, values, ends = np.empty(grid.shape[::-1], np.uint16), [], [0]
            for d in range(len(places)):
                own, places[d] = np.unique(grid[:, d], return_inverse=True)
                values.append(own.astype(np.int32))
                ends.append(ends[-1] + len(own))
            listed = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.concat_arrays(c.chunks))
            return pa.RecordBatch.from_arrays([
                listed(rows.column(0)), listed(rows.column(1)), pa.array([places.tobytes()], pa.binary()),
                pa.array([np.concatenate(values).tobytes()], pa.binary()), pa.array([ends], pa.list_(pa.int32()))],
                names=["vec_id", "label", "places", "dictionary", "ends"])

        waiting = None
        for batch in batches:
            waiting = pa.Table.from_batches([batch]) if waiting is None else pa.concat_tables([waiting, pa.Table.from_batches([batch])])
            while waiting.num_rows >= block:
                yield one(waiting.slice(0, block))
                waiting = waiting.slice(block)
        if waiting is not None and waiting.num_rows:
            yield one(waiting)

    return rows.select("vec_id", "label", "v").mapInArrow(
        run, f"vec_id array<bigint>, label array<{label}>, places binary, dictionary binary, ends array<int>")


class Block:
    """A packed block, as arrays."""

    def __init__(self, places: bytes, dictionary: bytes, ends):
        import numpy as np

        self.ends, self.values = list(ends), np.frombuffer(dictionary, np.int32).astype(np.int64)
        self.width = len(self.ends) - 1
        self.places = np.frombuffer(places, np.uint16).reshape(self.width, -1)

    def assigned(self, books):
        """Per part: places of the nearest entries and their squared distances. `books`: parts x entries x dimensions of a part."""
        import numpy as np

        parts, entries, size = books.shape
        for p in range(parts):
            total = np.zeros((self.places.shape[1], entries), np.int64)
            for j in range(size):
                d = p * size + j
                gaps = self.values[self.ends[d]:self.ends[d + 1], None] - books[p, :, j]
                total += (gaps * gaps)[self.places[d]]
            nearest = total.argmin(1)  # the first of equals
            yield nearest, total[np.arange(len(nearest)), nearest]

    def sums(self, books):
        """Rows (part, entry, count, sums of its parts) of the entries in use."""
        import numpy as np

        parts, entries, size = books.shape
        for p, (nearest, _) in enumerate(self.assigned(books)):
            counts = np.bincount(nearest, minlength=entries)
            by_dimension = []
            for j in range(size):
                d = p * size + j
                total = np.zeros(entries, np.int64)
                np.add.at(total, nearest, self.values[self.ends[d]:self.ends[d + 1]][self.places[d]])
                by_dimension.append(total)
            for e in np.flatnonzero(counts):
                yield p, int(e), int(counts[e]), [int(t[e]) for t in by_dimension]


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES):
    """Codebooks of the parts of the vectors with the smallest ids."""
    import numpy as np

    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v", "label").limit(entries).select("v").collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    return np.array([r.v for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)


def improved(blocks: DataFrame, books):
    """Codebooks after one round: each entry becomes the mean, rounded down, of the parts nearest to it."""
    given = books.copy()

    def run(batches):
        import pyarrow as pa

        totals: dict = {}
        for batch in batches:
            for places, dictionary, ends in zip(*(c.to_pylist() for c in batch.columns)):
                for p, e, n, s in Block(places, dictionary, ends).sums(given):
                    old = totals.get((p, e))
                    totals[p, e] = (n, s) if old is None else (old[0] + n, [a + b for a, b in zip(old[1], s)])
        for (p, e), (n, s) in totals.items():
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([p] * len(s), pa.int32()), "entry": pa.array([e] * len(s), pa.int32()),
                "at": pa.array(range(len(s)), pa.int32()), "n": pa.array([n] * len(s), pa.int64()), "s": pa.array(s, pa.int64())})

    found = blocks.select("places", "dictionary", "ends").mapInArrow(run, "part int, entry int, at int, n long, s long").groupBy(
        "part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # a row per component of the codebooks
    books = given.copy()
    for r in found:
        books[r.part, r.entry, r.at] = r.s // r.n
    return books


def coded(blocks: DataFrame, books) -> DataFrame:
    """vec_id, label, code and error of every packed vector."""
    label = blocks.schema["label"].dataType.elementType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        digits = np.array([list(f"{e:02x}".encode()) for e in range(256)], np.uint8)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, *block = (batch.column(c)[i] for c in range(5))
                found = list(Block(*(x.as_py() for x in block)).assigned(books))
                code = digits[np.stack([nearest for nearest, _ in found], 1)].reshape(len(ids), -1)
                error = np.sum([distance for _, distance in found], 0)
                yield pa.RecordBatch.from_arrays([
                    ids.values, labels.values, pa.array([row.tobytes().decode() for row in code], pa.string()),
                    pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def compressed(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
               entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK):
    """(vec_id, label, code and error of each usable vector; the codebooks: parts x entries x dimensions of a part)."""
    import numpy as np

    usable = saved(integers(rows, id, vector, label, parts), "vector-integers")
    books = first_books(usable, parts, entries)
    if not books.size:  # no usable vector
        return usable.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), int)
    blocks = saved(packed(usable, block), "vector-blocks")
    for _ in range(rounds):
        books = improved(blocks, books)
    return coded(blocks, books), books


def op12_vector_codes(spark, sf_dir):
    rows, books = compressed(read(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = saved(rows, "vector-codes")
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


QUERIES = {"op12_vector_codes": op12_vector_codes}


def _round(k: int) -> str:
    """SQL of one assignment to codebook k, and of codebook k + 1."""
    return f"""
near{k} AS MATERIALIZED (
    SELECT c.vec_id, c.part, b.entry FROM cut c JOIN book{k} b ON b.part = c.part
    QUALIFY row_number() OVER (PARTITION BY c.vec_id, c.part ORDER BY
        (c.s1 - b.s1) ** 2 + (c.s2 - b.s2) ** 2 + (c.s3 - b.s3) ** 2 + (c.s4 - b.s4) ** 2, b.entry) = 1),
book{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.s1, b.s1) AS s1, coalesce(m.s2, b.s2) AS s2, coalesce(m.s3, b.s3) AS s3, coalesce(m.s4, b.s4) AS s4
    FROM book{k} b LEFT JOIN (
        SELECT n.part, n.entry, floor(sum(c.s1) / count(*))::bigint AS s1, floor(sum(c.s2) / count(*))::bigint AS s2,
            floor(sum(c.s3) / count(*))::bigint AS s3, floor(sum(c.s4) / count(*))::bigint AS s4
        FROM near{k} n JOIN cut c ON c.vec_id = n.vec_id AND c.part = n.part GROUP BY n.part, n.entry) m
    ON m.part = b.part AND m.entry = b.entry),"""


# vectors of 64 components: parts of four
ORACLE = {"op12_vector_codes": f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
    SELECT vec_id, part, v[4 * part + 1] AS s1, v[4 * part + 2] AS s2, v[4 * part + 3] AS s3, v[4 * part + 4] AS s4
    FROM kept CROSS JOIN (SELECT unnest(range(16)) AS part)),
book0 AS MATERIALIZED (
    SELECT c.part, f.entry, c.s1, c.s2, c.s3, c.s4
    FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64) f
    JOIN cut c ON c.vec_id = f.vec_id),{_round(0)}{_round(1)}
gaps AS (
    SELECT c.vec_id, c.part, b.entry, (c.s1 - b.s1) ** 2 + (c.s2 - b.s2) ** 2 + (c.s3 - b.s3) ** 2 + (c.s4 - b.s4) ** 2 AS gap
    FROM cut c JOIN book2 b ON b.part = c.part),
final AS (
    SELECT vec_id, part, entry, gap FROM gaps QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY gap, entry) = 1),
coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry::int), '' ORDER BY part) AS code, sum(gap)::bigint AS error FROM final GROUP BY vec_id),
digest AS (
    SELECT sha256(string_agg(s1 || ',' || s2 || ',' || s3 || ',' || s4, ',' ORDER BY part, entry)) AS d FROM book2)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::bigint AS label_error, d.d AS codebooks_sha256
FROM kept k JOIN coded c ON c.vec_id = k.vec_id CROSS JOIN digest d
"""}
