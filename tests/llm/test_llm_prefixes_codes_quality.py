"""Prefix trie, vector codes and the classifier of unlabelled text: brute force, odd inputs, held-out accuracy."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import dictionary_codes as codes, prefix_trie as trie, unlabelled
from quayside.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, n_convs int, own string"


# prefix trie

def brute_force(turns):
    """{(depth, smallest member): (parent, members, children, leaves, saved, digest)} of (conv, turn, role, text) rows."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            id = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, id, len(text)))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h, family = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole[c] = tuple(own.get(family, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(sums[k][0] for k in kids[p]) if kids[p] else 1
        saved = sum(sums[k][1] for k in kids[p]) + (len(members[p]) - 1) * (p[-1][1] if p else 0)
        sums[p] = leaves, saved
    found = []
    for p, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if whole[c] == p)))
        found.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(kids[p]), *sums[p],
                      hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def some_turns(seed, convs, texts):
    rnd = random.Random(seed)
    turns = []
    for c in convs:
        for t in range(rnd.choice([1, 1, 2, 4, 9])):
            turns.append((c, rnd.choice([t, t, t, None, 0]), rnd.choice(["user", "bot", None, ""]), rnd.choice(texts)))
    return turns


@pytest.mark.parametrize("seed,part_bytes", [(1, 1), (2, 400), (3, 1 << 20)])
def test_trie_equals_brute_force(rows, spark, seed, part_bytes):
    texts = ["", None, "a", "ä€", "x" * 40] if seed != 2 else ["a"]
    turns = some_turns(seed, [*range(0, 130), *range(-120, -90), 250, 9_000_000_000, 9_000_000_001], texts)
    turns += turns[:20] + [(None, 0, "user", "lost"), (300, 0, "user", "é" * 3)]
    turns += [(400, i, "user", str(i)) for i in range(300)] + [(500, i, "user", str(i % 3)) for i in range(70)]
    whole = trie.rebuilt(rows(TURNS, *[(*t, 7, "z") for t in turns]))
    found = trie.prefix_trie(whole, part_bytes)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(turns)


def test_trie_of_nothing_and_of_copies(rows):
    assert trie.prefix_trie(trie.rebuilt(rows(TURNS))).collect() == []
    copies = [(100 * c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    found = {r.depth: r for r in trie.prefix_trie(trie.rebuilt(rows(TURNS, *[(*t, 1, "") for t in copies])), 64).collect()}
    assert len(found) == 4 and found[3].n_convs == 300 and found[0].n_leaves == 1 and found[0].saved_tokens == 3 * 299 * 6
    assert found[3].ends_sha256 == hashlib.sha256(",".join(str(100 * c) for c in range(300)).encode()).hexdigest()


def test_layouts_grow_and_hold_every_key():
    rnd = random.Random(4)
    keys = {bytes([a, b]) * 3 for a in range(256) for b in range(0, 256, 37)} | {bytes(rnd.randbytes(rnd.randint(0, 9))) for _ in range(3000)}
    tree = trie.RadixTree()
    for k in keys:
        tree.insert(k, k)
    found, todo, kinds = set(), [(tree.root, b"")], set()
    while todo:
        node, path = todo.pop()
        path += node.path
        if node.value is not None:
            assert node.value == path
            found.add(path)
        if node.kids:
            kinds.add((type(node.kids).__name__, getattr(node.kids, "room", 0)))
            listed = list(node.kids.items())
            assert [b for b, _ in listed] == sorted(b for b, _ in listed) and all(node.kids.get(b) is n for b, n in listed)
            todo += [(n, path + bytes([b])) for b, n in listed]
    assert found == keys and kinds == {("Few", 4), ("Few", 16), ("Some", 0), ("Many", 0)}


# vector codes

def coded_plainly(vectors, parts=16, entries=64, rounds=2):
    """codes and errors of (id, vector, label) rows in the order of their ids, and the codebooks."""
    ints = [[int(np.floor(256 * np.float64(x))) for x in v] for _, v, _ in vectors]
    size = len(ints[0]) // parts
    cut = [[tuple(v[p * size:(p + 1) * size]) for p in range(parts)] for v in ints]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [[min((gap(v[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)] for v in cut]
    for _ in range(rounds):
        to = near()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, n in zip(cut, to) if n[p][1] == e]
                if own:
                    books[p][e] = tuple(sum(c) // len(own) for c in zip(*own))
    to = near()
    return {r[0]: ("".join(f"{i:02x}" for _, i in n), sum(g for g, _ in n)) for r, n in zip(vectors, to)}, books


VECTORS = "vec_id long, embedding array<float>, label int, code string, entry int"


@pytest.mark.parametrize("n,block", [(150, 7), (40, 8192)])
def test_codes_equal_brute_force(rows, n, block):
    rng = np.random.default_rng(n)
    vectors = [(3 * i, [float(np.float32(x)) for x in rng.choice([-0.51, 0.0, 0.3, 0.75, 2.5], 32) + rng.integers(0, 2) * 0.11], i % 3 or None)
               for i in range(n)]
    odd = [(1, None, 1), (2, [], 1), (4, [None] * 32, 1), (5, [float("nan")] * 32, 2), (7, [float("inf")] * 32, 2), (8, [1.0] * 16, 1), (10, [1.0] * 31, 1)]
    df = rows(VECTORS, *[(*r, "x", 9) for r in vectors + odd]).repartition(5)
    found, books = codes.compressed(df, block=block)
    want, want_books = coded_plainly(vectors)
    assert {r.vec_id: (r.code, r.error) for r in found.collect()} == want
    assert books.tolist() == [[list(e) for e in p] for p in want_books]


def test_codes_of_odd_tables(rows, spark, tmp_path):
    same = [(i if i else None, [0.1] * 16, None) for i in range(5)] + [(3, [0.1] * 16, 2), (9, [1e38, -1e38] * 8, 2)]
    for name, data in (("some", same), ("none", []), ("bad", [(1, None, 1)])):
        rows(VECTORS, *[(*r, "x", 9) for r in data]).write.parquet(str(tmp_path / name / "embeddings.parquet"))
        found = QUERIES["op12_vector_codes"](spark, str(tmp_path / name)).collect()
        assert len(found) == len(data) * (name == "some")
    found = QUERIES["op12_vector_codes"](spark, str(tmp_path / "some")).collect()
    assert all(len(r.code) == 32 for r in found) and {r.label_error for r in found if r.vec_id is None} == {0}


# classifier

def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op13_quality_classifier"](spark, folder).toPandas()
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count() and found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= 0.5)).all()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    held = found[found["held_out"]].merge(labels, on="doc_id")
    assert (held["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3) == 1).all()
    bad, good = held[held["quality"] == 0], held[held["quality"] == 1]
    assert (bad["predicted"] == 0).mean() > 0.9 and (good["predicted"] == 1).mean() > 0.98


def test_held_out_and_bad_labels_teach_nothing(rows):
    stats = rows("doc_id long, x array<double>", *[(i, [float(i)] * 14) for i in range(60)])
    labels = rows("doc_id long, quality int", *[(i, 1) for i in range(30)], *[(i, 0) for i in range(30, 60)], (3, None), (4, 0), (5, 7), (None, 1))
    good = {r.doc_id for r in unlabelled.with_positives(stats, labels).collect() if r.good}
    assert good == {i for i in range(30) if zlib.crc32(str(i).encode()) % 3 != 1}


def test_risk_and_its_derivatives_equal_plain_sums(rows, spark):
    rng = np.random.default_rng(2)
    x, good = rng.random((40, 14)), rng.integers(0, 2, 40)
    df = rows("x array<double>, good int", *[([float(v) for v in r], int(g)) for r, g in zip(x, good)]).repartition(3)
    knots = [[0.0, 0.3, 0.9]] * 14
    w = rng.standard_normal(43)

    def plain(w):
        z = unlabelled.basis(x, knots) @ w
        p = good == 1
        return 0.7 * np.logaddexp(0, -z[p]).mean() + max(0.0, np.logaddexp(0, z).mean() - 0.7 * np.logaddexp(0, z[p]).mean()), (
            np.logaddexp(0, -z[p]).mean() + np.logaddexp(0, z).mean())

    s = unlabelled.passed(df, knots, w)
    for risk, at in ((unlabelled.unbiased(0.7), 0), (unlabelled.told_apart, 1)):
        value, slope, curve, bad = risk(s)
        assert abs(value - plain(w)[at]) < 1e-9 and (at or bad > 0)
        for i in (0, 7, 42):
            step = np.zeros(43)
            step[i] = 1e-5
            assert abs((plain(w + step)[at] - plain(w - step)[at]) / 2e-5 - slope[i]) < 1e-6
        assert np.allclose(curve, curve.T)


def test_no_step_takes_the_risk_of_bad_documents_below_zero(rows, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.random((60, 14))
    df = rows("x array<double>, good int", *[([float(v) for v in r], int(i % 2)) for i, r in enumerate(x)]).cache()
    seen = []
    risk = unlabelled.unbiased(0.9)
    w = unlabelled.minimised(df, [[0.0, 0.25, 0.5, 0.75, 1.0]] * 14, lambda s: seen.append(risk(s)) or risk(s), 2.0)
    value, _, _, bad = risk(unlabelled.passed(df, [[0.0, 0.25, 0.5, 0.75, 1.0]] * 14, w))
    assert bad >= 0 and value <= seen[0][0]


def test_prior_of_a_known_mixture(rows):
    rng = np.random.default_rng(5)
    kind = rng.random(6000) < 0.7  # good ones among all
    x = np.where(kind, rng.normal(2, 0.5, 6000), rng.normal(-2, 0.5, 6000))
    data = [([float(v)] * 14, int(k and i % 3 == 0)) for i, (v, k) in enumerate(zip(x, kind))]
    df = rows("x array<double>, good int", *data)
    w = np.zeros(14 * 2 + 1)
    w[1], w[-1] = 6.0, -3.0
    found = unlabelled.prior_of(df, [[-4.0, 4.0]] * 14, w)
    assert abs(found - 0.7) < 0.05


def test_classifier_of_odd_tables(rows, spark, tmp_path):
    docs = "doc_id long, text string, lang string, source string, n_chars long, x int, good int, score int"
    odd = [(1, None, None, None, 0, 1, 1, 1), (2, "", "", "", 0, 1, 1, 1), (None, "a b", None, None, 0, 1, 1, 1),
           (4, "word " * 300_000, "en", "s", 0, 1, 1, 1), (4, "same id", "en", "s", 0, 1, 1, 1), (5, "😀 1" * 3, "en", "s", 0, 1, 1, 1)]
    for name, rows_, labels in (("none", [], []), ("unlabelled", odd, []), ("some", odd * 2, [(i, 1, 0) for i in range(1, 6)])):
        rows(docs, *rows_).write.parquet(str(tmp_path / name / "documents.parquet"))
        rows("doc_id long, quality int, toxic int", *labels).write.parquet(str(tmp_path / name / "labels.parquet"))
        found = QUERIES["op13_quality_classifier"](spark, str(tmp_path / name)).collect()
        assert len(found) == len(rows_) and all(0 <= r.score <= 1 for r in found)
        if name == "unlabelled":
            assert {r.score for r in found} == {0.5}
