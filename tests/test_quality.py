"""Key sets as bits and checksums of buckets against plain sets and comparisons."""

import random

from pyspark.sql import functions as F

from quayside.operators import quality as dq


def test_lacking_keys_equal_set_difference(rows, spark):
    rnd = random.Random(1)
    a = [rnd.choice([None, rnd.randint(-200, 200), rnd.randint(-2**62, 2**62), 63, 64, -1, -64, -65, 2**63 - 1, -2**63]) for _ in range(500)]
    b = [k for k in a if rnd.random() < 0.5] + [5, None]
    left, right = rows("k bigint", *[(k,) for k in a]).repartition(3), rows("id bigint", *[(k,) for k in b])
    got = [r["k"] for r in dq.lacking(left, "k", right, "id").collect()]
    assert sorted(got) == sorted({k for k in a if k is not None} - set(b))
    orphans = {r["k"]: r["n_rows"] for r in dq.orphans(left, right, "k", "id").collect()}
    assert orphans == {k: a.count(k) for k in got}
    assert dq.missing_keys(left, left, "k").count() == 0 and dq.missing_keys(left, left.limit(0), "k").count() == len(set(a) - {None})
    assert dict(dq.lacking(rows("k int", (3,)), "k", right, "id").dtypes) == {"k": "int"}


def test_keys_that_are_no_whole_numbers(rows):
    left, right = rows("k string", ("a",), ("a",), ("b",), (None,)), rows("k string", ("b",))
    assert [tuple(r) for r in dq.orphans(left, right, "k", "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in dq.missing_keys(left, right, "k").collect()] == [("a",)]


def test_key_sets_shuffle_words_and_not_keys(spark):
    plan = dq.lacking(spark.range(10_000), "id", spark.range(5, 9_000), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "Distinct" not in plan


def test_checksums_open_what_differs_and_nothing_else(rows, spark):
    rnd = random.Random(2)
    base = [(i, rnd.choice([None, "a", "b"]), rnd.choice([None, 1.5, -0.0])) for i in range(400)]
    other = [(i, "c" if i % 50 == 7 else a, None if i % 70 == 3 else b) for i, a, b in base if i % 90] + [(1000, "x", 1.0), (None, "y", 2.0)]
    left, right = rows("id int, a string, b double", *base), rows("id int, a string, b double", *other).repartition(5)
    fast = sorted(map(tuple, dq.field_diff(left, right, "id", ["a", "b"], keys_unique=True).collect()))
    assert fast == sorted(map(tuple, dq.field_diff(left, right, "id", ["a", "b"]).collect())) and len(fast) > 5
    assert dq.differing_buckets(left, left.repartition(4), "id", ["a", "b"]).count() == 0
    assert dq.differing_buckets(left, left.union(left.limit(1)), "id", ["a", "b"]).count() == 1  # a row more is a difference
