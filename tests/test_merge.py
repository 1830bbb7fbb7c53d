"""Laws of the merge, on literal cases and on a run of snapshots."""

from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quayside.operators import merge as mg
from quayside.operators.numbering import number_rows
from quayside.operators.store import Store
from quayside.session import new_folder

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2, 6, 30)
SPEC = mg.MergeSpec(("id",), ("id", "name"), ("id", "name"))
DW = "dw_id bigint, id bigint, name string, dw_last_inserted timestamp_ntz, dw_last_updated timestamp_ntz"
STG = "id bigint, name string"


def _run(rows, dw, stg, spec=SPEC, **kw):
    merged = mg.merge(rows(DW, *[(*r, T1, T1) for r in dw]), rows(STG, *stg), spec, T2, **kw)
    return sorted(((r["id"], r["name"], r["_action"], r["dw_last_inserted"], r["dw_last_updated"]) for r in merged.collect()), key=str)


def test_insert(rows):
    assert _run(rows, [], [(1, "a")]) == [(1, "a", "insert", T2, T2)]


def test_no_change(rows):
    assert _run(rows, [(1, 1, "a")], [(1, "a")]) == [(1, "a", "keep", T1, T1)]
    unconditional = mg.MergeSpec(("id",), ("id", "name"))
    assert _run(rows, [(1, 1, "a")], [(1, "a")], unconditional) == [(1, "a", "update", T1, T2)]


def test_to_and_from_null(rows):
    got = _run(rows, [(1, 1, "a"), (2, 2, None), (3, 3, None)], [(1, None), (2, "b"), (3, None)])
    assert got == [(1, None, "update", T1, T2), (2, "b", "update", T1, T2), (3, None, "keep", T1, T1)]


def test_note_alone_is_no_change(rows):
    spec = mg.MergeSpec(("id",), ("id", "name"), ("id",))
    assert _run(rows, [(1, 1, "note1")], [(1, "note2")], spec) == [(1, "note1", "keep", T1, T1)]


def test_absent_rows_stay(rows):
    assert _run(rows, [(1, 9, "z")], []) == [(9, "z", "keep", T1, T1)]


def test_null_key_inserts_again(rows):
    got = _run(rows, [(1, None, "a")], [(None, "a")])
    assert got == [(None, "a", "insert", T2, T2), (None, "a", "keep", T1, T1)]


def test_duplicates(rows):
    with pytest.raises(mg.AmbiguousSource):
        _run(rows, [(1, 1, "a")], [(1, "b"), (1, "c")])
    assert [r[2] for r in _run(rows, [(1, 1, "a")], [(1, "b"), (1, "c")], on_duplicate="keep")] == ["keep"]
    assert [r[1:3] for r in _run(rows, [(1, 5, "a")], [(1, "b"), (1, "c")])] == [("b", "insert"), ("c", "insert"), ("a", "keep")]
    # a repeated warehouse key is updated wherever it occurs
    assert [r[1:3] for r in _run(rows, [(1, 1, "a"), (2, 1, "b")], [(1, "c")])] == [("c", "update")] * 2


def test_sentinels(rows):
    spec = mg.MergeSpec(("id",), ("id", "name"), ("id", "name"), sentinels=True)
    assert [r[2] for r in _run(rows, [(1, 1, "~NULL~"), (2, 2, "x")], [(1, None), (2, None)], spec)] == ["keep", "update"]


def test_composite_key(rows):
    spec = mg.MergeSpec(("location_id", "day"), ("location_id", "day"))
    dw = rows("dw_id bigint, location_id bigint, day string, dw_last_inserted timestamp_ntz, dw_last_updated timestamp_ntz",
              (1, 5, "d1", T1, T1), (2, 5, "d2", T1, T1))
    merged = mg.merge(dw, rows("location_id bigint, day string", (5, "d1"), (5, "d2")), spec, T2)
    assert merged.count() == 2 and {r["_action"] for r in merged.collect()} == {"update"}


def test_runs(spark, rows, tmp_path):
    """Idempotent, no deletes, surrogate keys and insert stamps stable, counters right."""
    store = Store(spark, str(tmp_path))
    day1, day2 = rows(STG, (3, "c"), (1, "a"), (2, "b")), rows(STG, (1, "A"), (4, "d"))
    assert mg.merge_table(store, "t", day1, SPEC, T1) == {"inserted": 3, "updated": 0, "kept": 0}
    assert mg.merge_table(store, "t", day1, SPEC, T2) == {"inserted": 0, "updated": 0, "kept": 3}
    before = {r["id"]: (r["dw_id"], r["dw_last_inserted"]) for r in store.read("t").collect()}
    assert before == {1: (1, T1), 2: (2, T1), 3: (3, T1)}
    t3 = datetime(2024, 1, 3)
    assert mg.merge_table(store, "t", day2, SPEC, t3) == {"inserted": 1, "updated": 1, "kept": 2}
    after = {r["id"]: (r["dw_id"], r["dw_last_inserted"]) for r in store.read("t").collect()}
    assert after == {**before, 4: (4, t3)}
    assert store.version("t") == 3


def test_known_unique_keys(spark, rows, tmp_path):
    """The log tells whether keys are unique; a repeated snapshot key is still found, and once inserted it is on record."""
    store = Store(spark, str(tmp_path))
    mg.merge_table(store, "t", rows(STG, (1, "a"), (2, "b")), SPEC, T1)
    assert store.keys_unique("t")
    with pytest.raises(mg.AmbiguousSource):
        mg.merge_table(store, "t", rows(STG, (1, "x"), (1, "y")), SPEC, T2)
    assert mg.merge_table(store, "t", rows(STG, (5, "x"), (5, "y"), (2, "c")), SPEC, T2) == {"inserted": 2, "updated": 1, "kept": 1}
    assert not store.keys_unique("t")
    t3 = datetime(2024, 1, 3)
    assert mg.merge_table(store, "t", rows(STG, (5, "z")), SPEC, t3) == {"inserted": 0, "updated": 2, "kept": 2}


KEYS = st.one_of(st.none(), st.integers(0, 6))
TEXTS = st.one_of(st.none(), st.sampled_from("abc"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(KEYS, TEXTS), max_size=8), st.lists(st.tuples(KEYS, TEXTS), max_size=8), st.booleans())
def test_one_join_or_two(spark, rows, old, new, tested):
    """Unique keys: the one-join merge of a stored table gives what the general merge gives."""
    def unique(pairs):
        return list({k if k is not None else (i,): (k, v) for i, (k, v) in enumerate(pairs)}.values())

    spec = mg.MergeSpec(("id",), ("id", "name"), ("id", "name") if tested else None)
    store = Store(spark, new_folder(spark, "law"))
    day1, day2 = rows(STG, *unique(old)), rows(STG, *unique(new))
    mg.merge_table(store, "t", day1, spec, T1)
    general = mg.merge(store.read("t"), day2, spec, T2)
    want = sorted(map(str, general.drop("_action").select("id", "name", "dw_last_inserted", "dw_last_updated", "dw_id").collect()))
    wanted_counts = mg.counters(general, T2).first().asDict()
    assert mg.merge_table(store, "t", day2, spec, T2) == wanted_counts
    got = store.read("t").select("id", "name", "dw_last_inserted", "dw_last_updated", "dw_id")
    assert sorted(map(str, got.collect())) == want


def test_run_all_stops_at_a_failure(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path))
    mg.merge_table(store, "bad", rows(STG, (1, "a")), SPEC, T1)
    staged = {"good": (rows(STG, (1, "a")), SPEC), "bad": (rows(STG, (1, "b"), (1, "c")), SPEC)}
    with pytest.raises(RuntimeError, match="merge of bad failed"):
        mg.run_all(store, staged, T2, at_a_time=1)
    assert store.read("bad").first()["name"] == "a"  # the failed merge left the table as it was


def test_failed_write_is_not_committed(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("t", rows("a int", (1,)))
    with pytest.raises(Exception):
        store.write("t", rows("a int", (0,)).select((F.lit(1) / F.col("a")).alias("a")))
    assert store.read("t").collect()[0]["a"] == 1 and store.read("nothing") is None


def test_numbering_is_dense_and_ordered(spark):
    n = 5000
    df = spark.range(n, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.pmod(F.col("id") * 7919, F.lit(1000))).alias("k"), (F.col("id") % 2).alias("v"))
    got = number_rows(df, ["k", "v"], "no", 100).orderBy("no").collect()
    assert [r["no"] for r in got] == list(range(101, n + 101))
    order = [(r["k"] is None, r["k"] or 0, r["v"]) for r in got]
    assert order == sorted(order)


def test_two_writers_keep_both_commits(spark, tmp_path):
    from quayside.operators.store import Store, VersionTaken

    store = Store(spark, str(tmp_path / "t"))
    one, two = spark.range(3).toDF("n"), spark.range(5).toDF("n")
    (number, folder), (same, other) = store.next_folder("t"), store.next_folder("t")
    one.write.parquet(folder)
    two.write.parquet(other)
    store.commit("t", number, [folder], one.schema.json())
    with pytest.raises(VersionTaken):
        store.commit("t", same, [other], two.schema.json())
    store.commit_whole("t", other, two.schema.json())  # a replacing writer takes the next number
    assert store.version("t") == 2 and store.read("t").count() == 5
    (tmp_path / "t/_versions/t/000000000003.json").write_text("")  # its writer died
    assert store.version("t") == 2 and store.write("t", one).count() == 3 and store.version("t") == 4
    assert store.expire("t", keep=1) == [1, 2, 3] and store.read("t").count() == 3
    assert len(store.files.names(f"{store.root}/t")) == 1


def _bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


NOTED = mg.MergeSpec(("id",), ("id", "name", "note"), ("id", "name"))


def _day(spark, rows, changed=(), upto=None):
    return spark.range(rows if upto is None else upto).select(
        "id", F.when(F.col("id").isin(*changed), "new").otherwise(F.concat(F.lit("name"), "id")).alias("name"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("note"))


def test_only_parts_with_a_change_are_written(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    mg.merge_table(store, "t", _day(spark, 20_000), NOTED, T1, part_rows=1000)
    first = store.newest("t")
    whole = _bytes(tmp_path / "t")
    late = [*range(19_800, 20_000)]  # one in a hundred
    assert mg.merge_table(store, "t", _day(spark, 20_000, late, 20_010), NOTED, T2, part_rows=1000) == {"inserted": 10, "updated": 200, "kept": 19_800}
    second = store.newest("t")
    assert len(first.parts) == 20 and len(set(first.parts) & set(second.parts)) == 19
    assert _bytes(tmp_path / "t") - whole < 0.1 * whole
    got = {r["id"]: r for r in store.read("t").collect()}
    assert len(got) == 20_010 and [got[i]["dw_id"] for i in (0, 19_999, 20_009)] == [1, 20_000, 20_010]
    assert got[19_900]["name"] == "new" and got[19_900]["dw_last_updated"] == T2 and got[19_900]["dw_last_inserted"] == T1
    assert got[5]["dw_last_updated"] == T1 and "_row_hash" not in store.read("t").columns
    t3 = datetime(2024, 1, 3)
    assert mg.merge_table(store, "t", _day(spark, 20_000, late, 20_010), NOTED, t3, part_rows=1000) == {"inserted": 0, "updated": 0, "kept": 20_010}
    assert store.newest("t").parts == second.parts  # an unchanged day writes nothing


def test_long_columns_are_in_no_shuffle_of_an_unchanged_day(spark, tmp_path, monkeypatch):
    store, seen = Store(spark, str(tmp_path)), []
    mg.merge_table(store, "t", _day(spark, 3000), NOTED, T1, part_rows=500)
    write = type(spark.range(1).write).parquet

    def watched(self, path, *a, **k):
        seen.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *a, **k)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", watched)
    mg.merge_table(store, "t", _day(spark, 3000), NOTED, T2, part_rows=500)
    assert len(seen) == 1 and "note" not in seen[0].split("Join")[0] and "sha2" not in seen[0]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(KEYS, TEXTS, TEXTS), max_size=8), st.lists(st.tuples(KEYS, TEXTS, TEXTS), max_size=8), st.booleans())
def test_hashes_tell_what_full_comparison_tells(spark, rows, old, new, sentinels):
    def unique(triples):
        return list({k if k is not None else (i,): (k, a, b) for i, (k, a, b) in enumerate(triples)}.values())

    ddl, spec = "id bigint, name string, note string", mg.MergeSpec(("id",), ("id", "name", "note"), ("name", "note"), sentinels)
    store = Store(spark, new_folder(spark, "law"))
    mg.merge_table(store, "t", rows(ddl, *unique(old)), spec, T1, part_rows=2)
    day2 = rows(ddl, *unique(new))
    general = mg.merge(store.read("t"), day2, spec, T2).drop("_action")
    want = sorted(map(str, general.select(sorted(general.columns)).collect()))
    assert mg.merge_table(store, "t", day2, spec, T2, part_rows=2) == mg.counters(general, T2).first().asDict()
    got = store.read("t")
    assert sorted(map(str, got.select(sorted(got.columns)).collect())) == want


def test_versions_by_number_time_and_snapshot(spark, rows, tmp_path):
    import time

    store = Store(spark, str(tmp_path))
    store.write("a", rows("n int", (1,)))
    store.write("b", rows("n int", (10,)))
    one = store.snapshot(["a", "b", "nothing"])
    between = datetime.now(timezone.utc)
    time.sleep(0.01)
    store.write("a", rows("n int", (2,)))  # a run that has not reached b yet
    value = lambda df: df.first()["n"]
    assert [value(df) for df in store.read_together().values()] == [1, 10] and value(store.read("a")) == 2
    store.write("b", rows("n int", (20,)))
    two = store.snapshot(["a", "b"])
    assert (one, two) == (1, 2) and [value(df) for df in store.read_together().values()] == [2, 20]
    assert [value(df) for df in store.read_together(1).values()] == [1, 10] and store.read_together(9) == {}
    assert value(store.read("a", as_of=1)) == 1 and value(store.read("a", as_of=between)) == 1 and store.read("a", as_of=7) is None
    assert store.read("a", as_of=datetime(2000, 1, 1)) is None
    (tmp_path / "_versions/_snapshots/000000000003.json").write_text("")  # its writer died
    assert [value(df) for df in store.read_together().values()] == [2, 20] and store.snapshot(["a"]) == 4


def test_changes_between_versions(spark, rows, tmp_path):
    store, ddl = Store(spark, str(tmp_path)), "id int, a string, b string"
    store.write("t", rows(ddl, (1, "x", None), (2, None, "x"), (3, "s", "s"), (4, "gone", None)))
    store.write("t", rows(ddl, (1, None, "x"), (2, None, "x"), (3, "s", "s"), (5, "new", None)))
    got = sorted(map(tuple, store.changes_between("t", 1, 2, ["id"]).collect()))
    assert got == [(1, None, "x", "update"), (4, "gone", None, "delete"), (5, "new", None, "insert")]
    assert store.changes_between("t", 2, 2, ["id"]).count() == 0


def test_a_store_without_atomic_creation_needs_locks(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="atomically"):
        Store(spark, "s3a://bucket/root")
    locks = str(tmp_path / "locks")
    store = Store(spark, str(tmp_path / "root"), locks)
    store.files.create = lambda path, text, of=store.files.create: of(path, text) if path.startswith(locks) else not _put(path, text)  # as an object store does
    number, _ = store.next_folder("t")
    (folder, df), (other, df2) = store.prepare("t", rows("n int", (1,))), store.prepare("t", rows("n int", (2,)))
    store.commit("t", number, [folder], df.schema.json())
    from quayside.operators.store import VersionTaken

    with pytest.raises(VersionTaken):
        store.commit("t", number, [other], df2.schema.json())
    assert store.read("t").first()["n"] == 1


def _put(path, text):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
