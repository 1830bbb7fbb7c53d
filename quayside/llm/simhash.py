"""Near copies by fingerprints that differ in a few bits, found with covering masks.

Each text is lower-cased (A to Z), cut into words, and its 4-word shingles,
repeats included, are hashed; a bit of the fingerprint is 1 if it is set in
over half the hashes. Fingerprints link at `radius` or fewer differing bits.

Candidates come from 2^(radius+1) - 1 tables. Bit i of the fingerprint has a
vector m(i) of radius + 1 bits, and table v keeps the bits i where m(i) and v
share an odd number of ones. The vectors of any `radius` differing bits leave
some v that is even with all of them; table v drops those bits, so there the
pair falls together: no pair within the radius is lost. All bit distances are
then checked. Equal fingerprints are put together first. A table's entry with
many fingerprints is split into blocks by hash, and each pair of blocks is
compared on its own, so that no task gets more than about two blocks. What
leaves a task is a star per set of linked fingerprints, never all pairs.

Defined results: a null text counts as empty; a text without a word has
fingerprint zero and links like any other; repeated rows share fingerprint and
group; a group is named by a null id only if it
has no other; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayside.llm.common import appended, key_of, read, saved, with_arrays
from quayside.llm.components import components
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

BITS, SEED = 64, 42


def fingerprint_of(text: str, words: int = 4) -> int:
    import itertools

    import numpy as np
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A to Z only, and the six ASCII blanks
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64)) + np.arange(len(found))
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(words, len(found)) - 1
    ones, total = np.zeros(BITS, np.int64), len(found) - last
    for lo in range(0, total, 4096):  # a very long text, piece by piece
        hi = min(total, lo + 4096)
        shingles = [joined[s:e] for s, e in zip(starts[lo:hi].tolist(), ends[lo + last:hi + last].tolist())]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), np.uint64, len(shingles))
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, into: str = "fp") -> DataFrame:
    """`docs` with the 64 bits of each whole text as a signed long."""
    out = appended(docs.schema, T.StructField(into, T.LongType(), False))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            bits = np.fromiter((fingerprint_of(t.as_py() or "", words) for t in texts), np.uint64, len(texts))
            yield with_arrays(batch, out.names, {into: pa.array(bits.view(np.int64))})

    return docs.mapInArrow(run, out)


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks of about half the bits; any `radius` bits are outside of one of them."""
    vectors = (1 << (radius + 1)) - 1
    assigned = [i % vectors + 1 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(assigned) if (m & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def links(prints: DataFrame, radius: int, block: int = 512) -> DataFrame:
    """Distinct `fp` -> links (a, b) that connect exactly those within `radius` bits, directly or by way of others."""
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("kept"))
                       for v, m in enumerate(covering_masks(radius))])
    entries = prints.select("fp", F.explode(tables).alias("t")).select("t.v", "t.kept", "fp")
    crowds = entries.groupBy("v", "kept").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block)
    own = F.pmod(F.xxhash64("fp"), blocks)
    meeting = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(
        F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi")))
    # Spark sizes entries as if there were one for each fingerprint, and would broadcast all of them: they are sorted and merged
    grouped = entries.join(crowds.hint("merge"), ["v", "kept"]).select("v", "kept", "fp", F.explode(meeting).alias("m")).groupBy(
        "v", "kept", "m.lo", "m.hi").agg(F.collect_list("fp").alias("fps"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            roots, leaves = [], []
            for fps in batch.column(0):
                for root, leaf in _stars(fps.values.to_numpy(), radius):
                    roots.append(root)
                    leaves.append(leaf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(roots, np.int64)), pa.array(np.array(leaves, np.int64))], names=["a", "b"])

    return grouped.select("fps").mapInArrow(run, "a long, b long").distinct()


def _stars(fps, radius: int):
    """(root, leaf) for each set of fingerprints that reach one another by steps of `radius` bits."""
    import numpy as np

    bits = fps.view(np.uint64)
    if len(bits) == 2:
        if int(bits[0] ^ bits[1]).bit_count() <= radius:
            yield fps[0], fps[1]
        return
    left = np.arange(len(bits))
    while len(left) > 1:
        root, edge, left = left[0], [left[0]], left[1:]
        while edge and len(left):
            near = np.bitwise_count(bits[left] ^ bits[edge.pop()]) <= radius
            reached, left = left[near], left[~near]
            edge += reached.tolist()
            for leaf in reached:
                yield fps[root], fps[leaf]


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of `docs`: id, fp, and component_id, the smallest id that can be reached over links.

    `key` is a hash of id and text, `first_key` that of the row which stands for its group.
    """
    printed = saved(fingerprints(docs.select(F.col(id).alias("doc_id"), key_of(id, text).alias("key"), F.col(text).alias(
        "text")), "text", words).select("doc_id", "key", "fp"), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    prints = saved(printed.groupBy("fp").agg(F.min(place).alias("first")), "distinct-fingerprints")
    roots = components(links(prints.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    grouped = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = grouped.groupBy("root").agg(F.min("first").alias("of_group"))
    named = saved(grouped.join(first, "root").select(
        "fp", F.col("of_group.doc_id").alias("component_id"), F.col("of_group.key").alias("first_key")), "fingerprint-groups")
    return printed.join(named, "fp").select("doc_id", "fp", "component_id", "key", "first_key")


def hex_of(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def op3_simhash(spark, sf_dir):
    return near_groups(read(spark, sf_dir, "documents")).select(
        "doc_id", hex_of().alias("fingerprint"), "component_id")


def first_of_groups(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies the document with the smallest id stays, once."""
    firsts = near_groups(docs).filter("key = first_key").select(F.col("key").alias("first"), F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", key_of().alias("key"))
    # partitioned by key alone, so that repeated rows meet where the join left them and documents are shuffled once
    same = F.coalesce(F.col("doc_id") == F.col("id"), F.col("doc_id").isNull() & F.col("id").isNull())
    stay = rows.join(firsts, (F.col("key") == F.col("first")) & same, "left_semi")
    return stay.dropDuplicates(["key", "doc_id"]).select("row.*")


QUERIES = {"op3_simhash": op3_simhash}
ORACLE: dict[str, str] = {}
