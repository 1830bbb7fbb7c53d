"""Mixing sources to target weights, with DataFrame functions only.

A text's size is its number of words. Sources in code point order (null last)
weigh `weights` in turn and share all words by weight. Capped water-filling: a
source whose share is over `max_epochs` times its own size is clamped there,
and what is left is shared anew among the others by weight, until none is
above. Each document is then taken as many whole times as its source's target
holds the source, and the rest of the target is filled with documents in the
order of a seeded hash of the id, up to the document at which the sum comes
nearest to the target.

The place where a source's last repetition ends is found without sorting the
source: sizes are summed by the first three hex digits of the hash, then,
within the three digits the target falls in, by the next three, and only the
documents that share all six are put in order. Sums are partly made before
each shuffle, so a hot source is no hot task.

Defined results: a null or blank text has size 0; sources without a word have
target 0 and nothing is taken of them; an empty table gives an empty result;
all rows of one id are taken alike; other columns pass through (`mixed`), and
one named like a result gives way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quayside.llm.common import BLANKS, WORD, read, saved, text_of
from quayside.operators.numbering import number_rows

WEIGHTS, MAX_EPOCHS, SEED = (1, 2, 3), 3, 8
DIGITS = 3  # of the hash, at a time


def word_count(text: Column) -> Column:
    """How many words a text has. No word is made: each gives way, with the blanks behind it, to one letter."""
    bare = F.trim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.char_length(F.regexp_replace(bare, f"{WORD}[{BLANKS}]*", "w")).cast("long")


def sized(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """id, source, size and hash of each row, and the row itself."""
    return docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id).alias("id"), F.col(source).cast("string").alias("source"),
        word_count(text_of(text)).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id).cast("string")).cast("binary")).alias("hash"))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target: one row per source."""
    sources = number_rows(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), ["source"], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = saved(sources.select(
        "source", "source_size", weight.cast("decimal(38,0)").alias("w"),
        (F.col("source_size") * max_epochs).cast("decimal(38,0)").alias("cap")), "sources")
    start = sources.agg(F.sum("source_size").cast("decimal(38,0)").alias("words"), F.sum("w").alias("w")).first()
    words, free, clamped = start.words or 0, start.w or 0, -1
    left = words
    while True:  # a level for the free sources; a clamped one stays clamped, as the level only rises
        over = _over(left, free)
        now = sources.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("cap"))).alias("cap"),
                          F.sum(F.when(~over, F.col("w"))).alias("w")).first()
        if now.n == clamped or not now.n:
            break
        clamped, left, free = now.n, words - now.cap, now.w
    share = (F.col("w") * F.lit(left).cast("decimal(20,0)")).cast("double") / F.lit(free).cast("double")
    return sources.select("source", "source_size", F.when(_over(left, free), F.col("cap").cast("double")).otherwise(
        share).alias("target"))


def _over(left, free) -> Column:
    number = lambda n: F.lit(n).cast("decimal(20,0)")
    return F.col("w").cast("decimal(10,0)") * number(left) > F.col("cap").cast("decimal(20,0)") * number(free).cast("decimal(18,0)")


def ends(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source: whole repetitions, and the hash at which the last one ends (`last`: whether that one is in)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    cuts = wanted.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")).select(
        "*", F.lit("").alias("digits"), F.lit(0).cast("long").alias("before"))
    small = sizes.select("source", "hash", "size")
    for level in (DIGITS, 2 * DIGITS):
        cuts = saved(_narrowed(small, cuts, F.substring("hash", 1, level), level - DIGITS), "cuts")
    order = Window.partitionBy("source").orderBy("hash")
    placed = _inside(small, cuts, 2 * DIGITS).withColumn("upto", F.col("before") + F.sum("size").over(order)).filter(
        "upto >= rest")
    end = placed.groupBy("source").agg(F.min(F.struct("upto", "hash")).alias("end"))
    # the rows of the ending hash: those before it sum to `upto` less their own sizes
    at = _inside(small, cuts, 2 * DIGITS).join(end.select(F.col("source").alias("s"), "end"), (
        F.col("source").eqNullSafe(F.col("s"))) & (F.col("hash") == F.col("end.hash"))).groupBy("source").agg(
        F.first("end").alias("end"), F.sum("size").alias("own"), F.first("rest").alias("rest"))
    near = at.select(F.col("source").alias("s"), F.col("end.hash").alias("end"), (
        F.col("end.upto") - F.col("rest") <= F.col("rest") - (F.col("end.upto") - F.col("own"))).alias("last"))
    return wanted.withColumn("whole", whole.cast("long")).join(
        near, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _inside(small: DataFrame, cuts: DataFrame, digits: int) -> DataFrame:
    """The rows that share their source's digits so far."""
    of = cuts.filter("rest > 0").select(F.col("source").alias("s"), "rest", "before", "digits")
    return small.join(of, F.col("source").eqNullSafe(F.col("s")) & (
        F.substring("hash", 1, digits) == F.col("digits") if digits else F.lit(True))).drop("s")


def _narrowed(small: DataFrame, cuts: DataFrame, digits: Column, known: int) -> DataFrame:
    """`cuts` with the digits in which the sum of sizes reaches the rest, and the sum before them."""
    sums = _inside(small, cuts, known).groupBy("source", digits.alias("d")).agg(
        F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("start"))
    # one row per source and digits
    upto = sums.withColumn("upto", F.col("start") + F.sum("size").over(Window.partitionBy("source").orderBy("d")))
    first = upto.filter("upto >= rest").groupBy("source").agg(F.min(F.struct("d", "upto", "size")).alias("m")).select(
        F.col("source").alias("s"), F.col("m.d").alias("d"), (F.col("m.upto") - F.col("m.size")).alias("b"))
    return cuts.join(first, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole", "rest", F.coalesce("d", "digits").alias("digits"),
        F.coalesce("b", "before").alias("before"))


def taken(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """`sizes` with source_size, target, `times` (whole repetitions of the row) and `taken` words."""
    of = plan.withColumnRenamed("source", "s")
    times = F.col("whole") + F.coalesce(
        (F.col("hash") < F.col("end")) | (F.col("hash") == F.col("end")) & F.col("last"), F.lit(False)).cast("long")
    return sizes.join(of, F.col("source").eqNullSafe(F.col("s"))).withColumn("times", times).withColumn(
        "taken", F.col("times") * F.col("size")).drop("s", "whole", "end", "last", "hash")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """`docs` as the mix takes them: each row as often as it is repeated."""
    every = sized(docs, id, text, source)
    sizes = saved(every.drop("row"), "sizes")
    plan = saved(ends(sizes, targets(sizes)), "mix")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("copy")
    return taken(every, plan).select("row", copies).select("row.*")


def op8_mixing(spark, sf_dir):
    sizes = saved(sized(read(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("row"), "sizes")
    plan = saved(ends(sizes, targets(sizes)), "mix")
    return taken(sizes, plan).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows repeated, or left out, as the mix takes them."""
    return mixed(docs)


QUERIES = {"op8_mixing": op8_mixing}

# water-filling by sorted caps instead of rounds, the cut by one running sum instead of digits
ORACLE = {"op8_mixing": r"""
WITH d AS (
    SELECT doc_id, source, length(regexp_replace(trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')), '[^ ]+', '', 'g'))
           + CASE WHEN trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) = '' THEN 0 ELSE 1 END AS size,
           md5('8:' || doc_id) AS hash
    FROM documents
), s AS (
    SELECT source, sum(size) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
    FROM d GROUP BY source
), t AS (SELECT sum(source_size) AS words FROM s
), o AS (
    SELECT s.*, 3 * source_size AS cap, words,
           coalesce(sum(3 * source_size) OVER r, 0) AS caps_before, sum(w) OVER () - coalesce(sum(w) OVER r, 0) AS w_left
    FROM s, t
    WINDOW r AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min(words - caps_before, caps_before) AS left_words, arg_min(w_left, caps_before) AS w_left
    FROM o WHERE w * (words - caps_before) <= cap * w_left
), g AS (
    SELECT source, source_size, CASE WHEN w * left_words > cap * level.w_left THEN CAST(cap AS DOUBLE)
           ELSE CAST(w * left_words AS DOUBLE) / CAST(level.w_left AS DOUBLE) END AS target
    FROM o, level
), p AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM g
), r AS (
    SELECT d.*, p.source_size, p.target, p.whole, target - whole * p.source_size AS rest,
           sum(size) OVER (PARTITION BY d.source ORDER BY hash) AS upto, sum(size) OVER (PARTITION BY d.source, hash) AS own
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), q AS (
    SELECT *, coalesce(min(CASE WHEN rest > 0 AND upto >= rest THEN hash END) OVER (PARTITION BY source), '') AS last_hash FROM r
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN hash < last_hash OR hash = last_hash AND upto - rest <= rest - (upto - own)
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM q
"""}
