"""Archives, neighbours, mixing, rules against brute force and SQL, and odd inputs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import diff, duck
from quayside.llm import mixing, neighbours, rules, warc
from quayside.llm.queries import ORACLE, QUERIES
from quayside.session import new_folder

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    assert diff(QUERIES[name](spark, sf), duck(sf), ORACLE[name]) is None


# archives

def test_archives_come_back_whatever_the_ranges(rows, spark):
    rnd, big = random.Random(2), "x" * 1500
    texts = [None, "", "a", big, big + "b", "\x1f�" * 900, "".join(chr(rnd.randint(32, 9000)) for _ in range(2000)), "y" * 300_000]
    pages = [(i, f"http://a/{i}%0a é\r\n" if i % 3 else None, rnd.choice(texts), 1) for i in range(60)] + [
        (None, "u", big, 1), (700, "twice", big + "b", 1), (700, "twice", big + "b", 1)]
    df = rows("page_id long, url string, html string, digest int", *pages)
    listed = warc.write_archives(df, new_folder(spark, "archives"))
    found = [sorted(tuple(map(str, r)) for r in warc.read_archives(listed, size).collect()) for size in (97, 1000, 1 << 30)]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(pages)
    back = {r.page_id: r for r in warc.read_archives(listed).collect()}
    largest = {}
    for i, _, html, _ in pages:
        if html and len(html.encode()) >= 1000 and i is not None:
            largest[html] = max(i, largest.get(html, -1))
    for i, url, html, _ in pages:
        r, first = back[i], largest.get(html)
        assert r.target_uri == (url and url.replace("\r\n", "%0D%0A")) and r.payload_bytes == len((html or "").encode())
        assert (r.record_type, r.refers_to) == (("response", None) if first in (None, i) else ("revisit", first))
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (html or "")


def test_bytes_that_look_like_a_record_are_passed_over():
    import io
    import zlib

    def member(data):
        c = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the magic inside stays visible
        return c.compress(data) + c.flush()

    row = {"payload": b"\x1f\x8b\x08" * 50 + member(b"not a record"), "refers_to": None, "page_id": 1, "digest": "00" * 20, "target_uri": None}
    import hashlib

    row["digest"] = hashlib.sha1(row["payload"]).hexdigest()
    raw = warc.packed(row)
    data = b"junk\x1f\x8b\x08" + member(b"other") + raw + raw
    got = [warc.parsed(r, True) for r in warc.members(io.BytesIO(data), 0, len(data), chunk=5)]
    assert [g["payload"] for g in got] == [row["payload"]] * 2


def test_archives_of_an_empty_table(rows, spark):
    listed = warc.write_archives(rows("page_id long, url string, html string", (1, "a", "b")).limit(0), new_folder(spark, "archives"))
    assert listed.count() == 0 and warc.read_archives(listed).count() == 0


# neighbours

def recall(found, ids, vectors, k=20):
    """Share of the true neighbours found; scores and order are checked on the way."""
    got, at, hits = {}, {i: n for n, i in enumerate(ids)}, 0
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for i, q in zip(ids, vectors):
        if i % 20 == 0:
            scores, other = (vectors * q).sum(1), ids != i
            best = ids[other][np.lexsort((ids[other], -scores[other]))[:k]]
            assert len(got[i]) == len(best) and all(abs(scores[at[v]] - s) < 1e-12 for v, s in got[i])
            assert got[i] == sorted(got[i], key=lambda f: (-f[1], f[0]))
            hits += len(set(best) & {v for v, _ in got[i]}) / len(best)
    return hits / len(got)


@pytest.mark.parametrize("leaf_rows,block", [(4096, 8192), (60, 25)])
def test_neighbours_are_found(spark, leaf_rows, block):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = table.collect()
    ids, vectors = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], float)
    assert recall(neighbours.nearest(table, leaf_rows=leaf_rows, block=block), ids, vectors) >= 0.9


def test_queries_skip_leaves_of_clustered_data(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = np.repeat(rng.standard_normal((12, 16)) * 6, 100, 0) + rng.standard_normal((1200, 16)) * 0.3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    routed = []
    of = neighbours._routed
    monkeypatch.setattr(neighbours, "_routed", lambda *a: routed.append(of(*a)) or routed[-1])
    found = neighbours.nearest(df, k=5, leaf_rows=100, block=70)
    assert recall(found, np.arange(1200), vectors, 5) >= 0.9
    assert 0 < routed[0].count() < 0.5 * 60 * 11  # of queries and other leaves


def test_search_stops_early_on_data_of_few_dimensions():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((4000, 3))
    norm2 = (points ** 2).sum(1).max()
    q, r, scores, verified = neighbours.search(np.arange(4000), points, points[:20] * 3, np.full(20, -np.inf), norm2, 5)
    hits = sum(len(set(np.argsort(-(points @ points[i]))[:5]) & set(r[q == i].tolist())) for i in range(20))
    assert hits >= 95 and verified < 0.85 * 20 * 4000 and np.allclose(scores, (points[r] * points[q] * 3).sum(1))


def test_planes_hold_every_point_whatever_repeats():
    points = np.array([[0.0, 0.0]] * 500 + [[1.0, i % 7] for i in range(500)])
    nodes = neighbours.planes(points, 32)
    leaves = neighbours.leaf_of(points, nodes)
    assert set(leaves) <= set(range(len(nodes) + 1)) and len(set(leaves)) > 3 and len(set(leaves[:500])) == 1
    assert neighbours.planes(points[:0], 4) == [] and (neighbours.leaf_of(points, []) == 0).all()


def test_vectors_that_take_no_part(rows):
    df = rows("vec_id long, embedding array<float>, v int", (0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (40, None, 1),
              (1, [0.0, 0.0], 1), (2, [float("nan"), 1.0], 1), (3, [None, 1.0], 1), (4, [1.0, 0.0], 1), (5, [3.0, 1.0], 1),
              (6, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (7, [float("inf"), 1.0], 1))
    assert sorted(map(tuple, neighbours.nearest(df).collect())) == [
        (0, 1, 5, 3.0), (0, 2, 4, 1.0), (0, 3, 20, 1.0), (20, 1, 5, 3.0), (20, 2, 0, 1.0), (20, 3, 4, 1.0)]
    assert neighbours.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [8192, 3])
def test_ties_of_a_hot_vector_go_to_smaller_ids(spark, block):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(200)] + [(i, [float(i), -1.0]) for i in range(200, 230)], "vec_id long, embedding array<float>")
    got = [r.vec_id for r in sorted(neighbours.nearest(df, k=40, leaf_rows=block, block=block).filter("query_id = 0").collect(), key=lambda r: r["rank"])]
    assert got == [*range(229, 199, -1), *range(1, 11)]


# mixing

def test_mix_of_odd_rows(rows, spark):
    df = rows(DOC, (1, "a b c", "en", "x", 1), (1, "a b c", "en", "x", 1), (2, None, "en", "x", 0), (3, "", "en", "empty", 0), (4, "w " * 300, "en", None, 1),
              (None, "a b", "en", "y", 1), (5, "q " * 50, "en", "y", 1)).withColumn("row", F.lit(1))
    sizes = mixing.saved(mixing.sized(df).drop("row"), "sizes")
    plan = {r.source: r for r in mixing.targets(sizes).collect()}
    assert {s: r.source_size for s, r in plan.items()} == {"empty": 0, "x": 6, "y": 52, None: 300}
    assert plan["x"].target == 18 and plan["empty"].target == 0  # clamped at three times
    assert abs(sum(r.target for r in plan.values()) - 358) < 1e-6
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.filter("doc_id = 1").count() == 6
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mixed(df.repartition(3)).collect()))
    assert mixing.mixed(df.limit(0)).count() == 0


def test_words_are_counted_without_a_list_of_them(rows):
    rng = random.Random(3)
    marks = " \t\n\x0b\x0c\r\x00\x1c\x85\xa0\u2003$\\ab\u00e9\U0001f600"
    texts = [None, "", " \n", " a ", *("".join(rng.choices(marks, k=rng.randrange(12))) for _ in range(500))]
    sizes = mixing.sized(rows("doc_id long, text string, source string", *[(i, t, "s") for i, t in enumerate(texts)]))
    assert {r.id: r.size for r in sizes.collect()} == {
        i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}
    assert "regexp_extract_all" not in sizes._jdf.queryExecution().optimizedPlan().toString()


def test_mix_comes_near_its_targets(spark):
    rnd = random.Random(8)
    docs = spark.createDataFrame([(i, "w " * rnd.randint(1, 60), rnd.choice("aaaaaaaabcd")) for i in range(3000)], "doc_id long, text string, source string")
    sizes = mixing.saved(mixing.sized(docs).drop("row"), "sizes")
    taken = mixing.taken(sizes, mixing.ends(sizes, mixing.targets(sizes)))
    for r in taken.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.max(F.col("taken") / F.col("size")).alias("m")).collect():
        assert abs(r.t - r.n) <= 60 and r.m <= 3


# rules

def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered, seen, again = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def test_statistics_equal_brute_force(spark, sf):
    rnd = random.Random(5)
    texts = [None, "", " ", "\n\n", "a", "ab " * 30_000] + ["".join(rnd.choice(["a", "b ", "\n", "a ", "# ", "é", "\x0b", " ", "😀"]) for _ in range(
        rnd.randint(0, 200))) for _ in range(300)] + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, words int")
    for r in rules.statistics(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_statistics(texts[r.doc_id])


def test_rules_learn_conjunctions(spark):
    rnd, data = random.Random(9), []
    for i in range(1500):
        words, marks = rnd.randint(20, 400), rnd.choice([0, 0, 1])
        bad = words > 200 and marks
        text = " ".join(["word"] * words) if not marks else " ".join(["word!"] * words)
        data.append((i, text, int(not bad) if rnd.random() > 0.03 else int(bad)))
    df = spark.createDataFrame(data, "doc_id long, text string, quality int")
    labelled = rules.statistics(df).join(df.select("doc_id", "quality"), "doc_id")
    found = rules.learn(labelled)
    assert found and len({c.feature for c in found[0]}) > 1  # neither length nor marks alone
    right = labelled.filter((rules.verdict(found).cast("int") == F.col("quality"))).count()
    assert right > 0.93 * len(data)


def test_rules_without_labels_keep_what_passes(spark, sf):
    counts = rules.statistics(spark.read.parquet(f"{sf}/documents.parquet"))
    assert rules.learn(counts.withColumn("quality", F.lit(1))) == [] and rules.learn(counts.limit(0).withColumn("quality", F.lit(1))) == []
    assert counts.filter(~rules.verdict([])).count() == 0


def test_native_operators_run_no_python(spark, sf, capsys):
    for name in ("op8_mixing", "op9_quality_rules"):
        QUERIES[name](spark, sf).explain()
        plan = capsys.readouterr().out
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
