"""Checks of a load: counts, keys, types, references, field by field."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def _check(name: str, expected: Column, actual: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), expected.cast("bigint").alias("expected"),
        actual.cast("bigint").alias("actual"), F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def _counts(**frames: DataFrame) -> DataFrame:
    """One row with the row count of each frame."""
    tagged = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.agg(*[F.max(F.when(F.col("side") == name, F.col("n"))).alias(name) for name in frames])


def _rows(one_row: DataFrame, *checks: Column) -> DataFrame:
    return one_row.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


WORD = 64  # keys of one word of a key set


def _whole(df: DataFrame, *columns: str) -> bool:
    return all(dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") for c in columns)


def key_words(df: DataFrame, key: str, name: str = "bits") -> DataFrame:
    """The set of a whole-number key as words of 64 bits: (word, bits). Keys that lie together travel as one row a task."""
    k = F.col(key).cast("bigint")
    bit = F.expr(f"shiftleft(1L, cast(pmod(cast(`{key}` as bigint), {WORD}) as int))")
    return df.filter(k.isNotNull()).select(F.shiftright(k, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias(name))


def keys_of_words(words: DataFrame, key: str, dtype: str) -> DataFrame:
    """The keys of a set given as (word, bits)."""
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("getbit", F.col("bits"), i) == 1)
    return words.select("word", F.explode(places).alias("place")).select((F.col("word") * WORD + F.col("place")).cast(dtype).alias(key))


def lacking(source: DataFrame, source_key: str, target: DataFrame, target_key: str) -> DataFrame:
    """Distinct keys of `source` that `target` lacks, under the source's name: one word of bits and-not the other."""
    both = key_words(source, source_key).join(key_words(target, target_key, "known"), "word", "left")
    left = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint"))))
    return keys_of_words(both.select("word", left.alias("bits")).filter("bits <> 0"), source_key, dict(source.dtypes)[source_key])


def missing_keys(source: DataFrame, target: DataFrame, key: str, *, sample: int | None = None) -> DataFrame:
    """Non-NULL keys of `source` that `target` lacks; `sample` looks at the lowest n keys only."""
    if not sample and _whole(source, key) and _whole(target, key):
        return lacking(source, key, target, key)
    keys = source.filter(F.col(key).isNotNull()).select(key)
    keys = keys.orderBy(key).limit(sample) if sample else keys.distinct()
    return keys.join(target.select(key).distinct(), key, "left_anti")


def null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


def reconcile(raw: DataFrame, stg: DataFrame, dw: DataFrame, key: str, *, sample: int | None = None) -> DataFrame:
    """Checks (check_name, expected, actual, passed) of one load; an empty source passes them all.

    Every source key is looked for in the warehouse; `sample` looks for the lowest n only.
    """
    lost = missing_keys(raw, dw, key, sample=sample)
    nulls = stg.filter(F.col(key).isNull())
    n = _counts(raw=raw, stg=stg, dw=dw, lost=lost, nulls=nulls)
    nothing = F.col("raw") == 0
    return _rows(
        n,
        _check("source rows staged", F.col("raw"), F.col("stg"), nothing | (F.col("raw") == F.col("stg"))),
        _check("staged rows in warehouse", F.col("stg"), F.col("dw"), nothing | (F.col("dw") >= F.col("stg"))),
        _check("source keys missing", F.lit(0), F.col("lost"), nothing | (F.col("lost") == 0)),
        _check("NULL keys staged", F.lit(0), F.col("nulls"), nothing | (F.col("nulls") == 0)),
    )


def check_merge(stg: DataFrame, dw: DataFrame, *, updates: int | None = None, inserts: int | None = None) -> DataFrame:
    """Staging fits into the warehouse; expected updates + inserts are the staged rows."""
    n = _counts(stg=stg, dw=dw)
    checks = [_check("staged rows in warehouse", F.col("stg"), F.col("dw"), F.col("stg") <= F.col("dw"))]
    if updates is not None or inserts is not None:
        total = F.lit((updates or 0) + (inserts or 0))
        checks.append(_check("updates and inserts", total, F.col("stg"), total == F.col("stg")))
    return _rows(n, *checks)


def check_types(df: DataFrame, expected: Mapping[str, str], *, sample: int | None = None) -> DataFrame:
    """(column_name, expected, actual, bad_values, passed) per column.

    A text column passes when every non-NULL value (or the first `sample` ones)
    casts to the expected type, any other when its type is the expected one.
    """
    types = dict(df.dtypes)

    def bad(c: str) -> Column:
        misfit = F.col(c).isNotNull() & F.col(c).try_cast(expected[c]).isNull()
        wrong_type = F.col(c).isNotNull()
        return F.count_if(F.lit(False) if types[c] == expected[c] else misfit if types[c] == "string" else wrong_type)

    if sample:
        parts = [df.select(c).filter(F.col(c).isNotNull()).limit(sample).agg(bad(c).alias("n"))
                 .select(F.lit(c).alias("column_name"), "n") for c in expected]
        counted = parts[0]
        for part in parts[1:]:
            counted = counted.unionByName(part)
    else:
        one = df.agg(*[bad(c).alias(c) for c in expected])
        counted = one.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in expected])).alias("c")).select("c.*")
    named = F.create_map(*[F.lit(v) for c in expected for v in (c, expected[c])])
    actual = F.create_map(*[F.lit(v) for c in expected for v in (c, types[c])])
    return counted.select(
        "column_name", named[F.col("column_name")].alias("expected"), actual[F.col("column_name")].alias("actual"),
        F.col("n").alias("bad_values"), (F.col("n") == 0).alias("passed"),
    )


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """(fk, n_rows): foreign keys without a parent row; NULL ones are no orphans.

    Whole-number keys meet as sets of bits, and only orphans are counted. Others
    are counted per key before they move, so a hot key travels as one row per task.
    """
    if _whole(child, fk) and _whole(parent, pk):
        gone = lacking(child, fk, parent, pk)
        return child.select(fk).join(gone, fk).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    used = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(pk).alias(fk)).distinct()
    return used.join(known, fk, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    return orphans(child, parent, fk, pk).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))


def _differences(left: DataFrame, right: DataFrame, key: str, cols: list[str], sample: int | None) -> DataFrame:
    if sample:
        left = left.join(left.select(key).orderBy(key).limit(sample), key, "left_semi")
    a, b = left.select(key, *cols).alias("a"), right.select(key, *cols).alias("b")
    differing = F.array_compact(F.array(*[
        F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.struct(
            F.lit(c).alias("column_name"), F.col(f"a.{c}").cast("string").alias("left_value"),
            F.col(f"b.{c}").cast("string").alias("right_value")))
        for c in cols
    ]))
    return a.join(b, key).select(key, differing.alias("_differing"))


BUCKETS = 4096  # of keys, compared by checksum


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def checksums(df: DataFrame, key: str, cols: list[str], prefix: str) -> DataFrame:
    """(bucket, rows and two checksums of them): equal ones hold equal rows, but for a chance of 2 ** -64 or so."""
    row = F.xxhash64(key, *[x for c in cols for x in (F.col(c), F.col(c).isNull())])
    return df.filter(F.col(key).isNotNull()).select(bucket_of(key).alias("bucket"), row.alias("h")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias(f"{prefix}_n"), F.sum(F.col("h").cast("decimal(38,0)")).alias(f"{prefix}_sum"), F.bit_xor("h").alias(f"{prefix}_xor"))


def differing_buckets(left: DataFrame, right: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The buckets of keys in which the two tables hold different rows: one aggregate each, and a row per bucket that meets."""
    both = checksums(left, key, cols, "l").join(checksums(right, key, cols, "r"), "bucket", "full_outer")
    same = F.lit(True)
    for c in ("n", "sum", "xor"):
        same = same & F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))
    return both.filter(~same).select("bucket")


def field_diff(left: DataFrame, right: DataFrame, key: str, cols: list[str], *, sample: int | None = None,
               keys_unique: bool = False) -> DataFrame:
    """(key, column_name, left_value, right_value) of every field that differs in records both sides hold.

    With `keys_unique`, checksums of buckets of keys are compared first, and only buckets that differ are opened: equal
    tables cost an aggregate each. Repeated keys would have to be compared crosswise even where checksums are equal.
    """
    if keys_unique and not sample and dict(left.dtypes)[key] == dict(right.dtypes)[key] and all(
            dict(left.dtypes)[c] == dict(right.dtypes)[c] for c in cols):
        opened = differing_buckets(left, right, key, cols)  # BUCKETS rows at most
        left, right = (df.withColumn("bucket", bucket_of(key)).join(F.broadcast(opened), "bucket", "left_semi").drop("bucket") for df in (left, right))
    return _differences(left, right, key, cols, sample).select(key, F.explode("_differing").alias("f")).select(key, "f.*")


def change_totals(stg: DataFrame, dw: DataFrame, key: str, cols: list[str], *, sample: int | None = None) -> DataFrame:
    """One row: records compared, records with changes, fields changed."""
    n = F.size("_differing")
    return _differences(stg, dw, key, cols, sample).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(n > 0).alias("records_with_changes"),
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("fields_changed"),
    )
