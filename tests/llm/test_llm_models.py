"""Toxicity and language model: restoring, held-out accuracy, likelihoods against plain formulas, odd inputs."""

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import gated_lm, toxicity

LONG = "lo ng " * 30_000


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


# toxicity

@pytest.fixture(scope="module")
def letters(spark, sf):
    return toxicity.letter_logs(toxicity.letter_counts(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")))


@pytest.mark.parametrize("disguised, plain", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("stuuuupid", "stupid"), ("s.c.u.m", "scum"), ("tr@sh", "trash"), ("cl0wn", "clown"),
    ("disgust1ng", "disgusting"), ("idiooot", "idiot"), ("m-o-r-o-n", "moron"), ("p@thet1c", "pathetic"),
    ("|diot", "idiot"), ("(lown", "clown"), ("moron!", "moron"), ("1diot!!", "idiot"), ("m o r o n", "moron")])
def test_words_are_restored(letters, disguised, plain):
    assert toxicity.restore(disguised, letters) == plain


def test_search_equals_trying_every_path(letters):
    for token in ("hat3", "a$$", "moron5", "s**m", "b@d!", "1|1", "a b c", "x.y-z", "aaa1", "(0w", "n1!e", "*a*"):
        best = None
        for path in product(*toxicity.lattice(token)):
            state, total = (0, 0, 0, ""), 0.0
            for option in path:
                state, cost = toxicity.arc(state, option, letters)
                total += cost
            a, b, d, _ = state
            total += float(letters[(a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + d][0])
            text = "".join(o[0] for o in path)
            best = min(best, (-total, text)) if best else (-total, text)
        assert toxicity.restore(token, letters) == best[1].strip(), token


def test_disguises_reach_the_lattice_and_plain_texts_stay_as_they_are(letters, monkeypatch):
    reader = toxicity.Reader(letters)
    assert reader.text("The cat, sat (on) it's mat!\n2024 +1 a@b.c")[:3] == ["the", "cat", "sat"]
    assert reader.text("you i d i o t now") == ["you", "idiot", "now"]
    assert reader.text("") == [] and reader.text("*** ---- 12 34") == ["", "", "12", "34"]
    seen = []
    monkeypatch.setattr(toxicity, "restore", lambda token, logs: seen.append(token) or token)
    toxicity.Reader(letters).text("hat3 a$$ moron5, |diot (lown s**m an i d i o t. you plain Words, here")
    assert seen == ["i d i o t", "hat3", "a$$", "moron5", "|diot", "(lown", "s**m"]


def test_texts_are_read_to_their_end(letters):
    """Words of a long spaced run, also between two pieces of it, and all words that plain marks join."""
    reader = toxicity.Reader(letters)
    for before in range(58, 70):
        run = " ".join("idiot" * 13 + "x" * before)[:2 * before] + "i d i o t , m o r o n"
        assert " ".join(reader.text(run)).replace(" ", "") == run.replace(" ", "").replace(",", "")  # each letter once
    for n in (12, 13, 14, 40):
        assert reader.text("you " + " ".join("idiot" * n) + " now") == ["you", *["idiot"] * n, "now"], n
    assert reader.text("1 " * 500 + "m 0 r o n")[-1] == "moron"
    assert reader.text("you/idiot,there") == ["you", "idiot", "there"]
    assert reader.text("plain/" * 30 + "1d1ot") == ["plain"] * 30 + ["idiot"]
    assert reader.text("you " + "i" * 80 + "di" + "o" * 90 + "t") == ["you", "idiot"]  # however long a letter is held
    assert reader.text("you" + "." * 80 + "there") == ["you", "there"]


def test_odd_tokens_take_no_long(letters):
    import time

    for long in ("a" + "*" * 100_000 + "b", "." * 1_000_000, "a1" * 300_000, "! " * 200_000, "a " * 200_000, "a" + "." * 500_000 + "a", "f****"):
        began = time.time()
        toxicity.Reader(letters).text(long)
        assert time.time() - began < 8, long[:10]


def test_toxicity_on_held_out_labels(spark, sf):
    big = sf.replace("0.001", "0.01")
    got = {r.doc_id: r for r in toxicity.op10_toxicity(spark, big).collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{big}/labels.parquet").collect()]
    assert len(got) == spark.read.parquet(f"{big}/documents.parquet").count()
    assert all(r.held_out == (fold(i, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(got[i].predicted, t) for i, t in labels if fold(i, 3) == 1]
    right = sum(p == t for p, t in held) / len(held)
    assert right > 0.9  # some labels are noise


def test_toxicity_reads_no_held_out_label(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    logs = np.zeros((toxicity.SYMBOLS ** 3, toxicity.SYMBOLS), np.float32)
    turned = labels.withColumn("toxic", F.when(gated_lm.fold("doc_id", 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels, logs) == toxicity.fit(docs, turned, logs)


def test_toxicity_is_learned_from_all_labels(rows, spark):
    """More labelled rows than were drawn before: every count and sum is one over all of them."""
    n, bad = 21_000, 2_000
    text = F.when(F.col("doc_id") < 3 * bad, F.concat(F.lit("you "), F.col("p"), F.lit(" zilch"))).otherwise(F.concat(F.lit("the "), F.col("p"), F.lit(" cat")))
    docs = spark.range(3 * n).withColumnRenamed("id", "doc_id").withColumn("p", F.element_at(F.array(*map(F.lit, "abc")), (F.col("doc_id") % 3 + 1).cast("int"))).select("doc_id", text.alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") < 3 * bad).cast("int").alias("toxic"))
    kept = labels.filter(gated_lm.fold("doc_id", 3) != 1)
    kinds = {r.toxic: r.n for r in kept.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(kinds.values()) > 30_000
    lexicon, weights = toxicity.fit(docs, labels, np.zeros((toxicity.SYMBOLS ** 3, toxicity.SYMBOLS), np.float32))
    # "zilch" stands behind three words; words of one letter do not count
    assert lexicon == {"zilch": pytest.approx(np.log(3.5 / (3 * kinds[1] + 1)) - np.log(0.5 / (3 * kinds[0] + 1)))}
    x = np.array([[1, lexicon["zilch"], np.log(2), np.sqrt(1 / 3)], [1, 0, 0, 0]])
    p, hold = 1 / (1 + np.exp(-x @ weights)), np.array([1e-3, 0.1, 0.1, 0.1])
    slope = x.T @ (np.array([kinds[1], kinds[0]]) * (np.array([1, 0]) - p)) - hold * weights
    assert np.abs(slope).max() < 1e-6


def test_words_that_speak_for_toxicity_equal_plain_counts(rows):
    """Also those that the first part of the clean rows leaves open."""
    rnd = np.random.default_rng(5)
    vocabulary = ["w" + "".join(x) for x in product("bcdef", "ghijkl", "mnopqrstuv")]
    texts = [" ".join(rnd.choice(vocabulary[:200] if i % 4 else vocabulary[150:], 25)) for i in range(400)]
    docs = rows("doc_id long, text string", *enumerate(texts))
    labels = rows("doc_id long, toxic int", *[(i, int(i % 4 == 0)) for i in range(400)])
    lexicon, _ = toxicity.fit(docs, labels, np.zeros((toxicity.SYMBOLS ** 3, toxicity.SYMBOLS), np.float32))
    kept = [i for i in range(400) if fold(i, 3) != 1]
    seen, sizes = {0: {}, 1: {}}, {0: 0, 1: 0}
    for i in kept:
        words = texts[i].split()
        sizes[int(i % 4 == 0)] += len(words)
        for before, w in zip(["", *words], words):
            seen[int(i % 4 == 0)].setdefault(w, set()).add(before)
    want = {}
    for w, before in seen[1].items():
        a, b = len(before), len(seen[0].get(w, ()))
        odds = np.log((a + 0.5) / (sizes[1] + 1)) - np.log((b + 0.5) / (sizes[0] + 1))
        if a >= toxicity.MIN_PLACES and a > b and odds >= toxicity.MIN_LOG_ODDS:
            want[w] = pytest.approx(odds)
    assert len(want) > 50 and want == lexicon


def test_only_words_asked_for_are_counted(rows):
    texts = rows("restored binary", *[(bytearray(zlib.compress(t.encode(), 1)),) for t in ("the cat sat", "a cat sat", "the cat", "")])
    assert {r.w: r.n for r in toxicity.surroundings(texts, "n").collect()} == {"the": 1, "cat": 2, "sat": 1}
    assert {r.w: r.n for r in toxicity.surroundings(texts, "n", rows("w string", ("cat",))).collect()} == {"cat": 2}


def test_toxicity_of_odd_rows(spark, rows):
    docs = rows("doc_id long, text string, score string", (1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a", "x"), (3, LONG, "x"))
    labels = rows("doc_id long, toxic int", (1, 0), (2, None), (None, 1), (3, 7), (3, 0))
    logs = toxicity.letter_logs(toxicity.letter_counts(docs))
    lexicon, weights = toxicity.fit(docs, labels, logs)
    got = toxicity.scored(docs, logs, lexicon, weights)
    assert lexicon == {} and got.count() == 5 and got.select("score").distinct().count() == 1
    assert toxicity.letter_counts(docs.limit(0)).sum() == 0 and toxicity.scored(docs.limit(0), logs, {}, weights).count() == 0


# language model

def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [""]


def test_base_scores_and_counts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    counts = Counter()
    for d in docs:
        if fold(d.doc_id, 5) != 1:
            counts.update(tokens(d.text))
    total, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in gated_lm.op6_lm_scores(spark, sf).collect()}
    for d in docs:
        r, words = got[d.doc_id], tokens(d.text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            fold(d.doc_id, 5) == 1, len(words), sum(w in counts for w in words), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words), rel_tol=1e-9)
        assert r.score < 0


def small_model():
    head = [("the", 50), ("", 40), ("of", 30), ("cat", 9), ("dog", 5)]
    corpus = gated_lm.Corpus(200, 30, head, 5, ["the", "", "of", "cat", "dog"], [0, 1, 3, 5], 66, 25)
    return corpus, gated_lm.start(corpus)


def test_probabilities_sum_to_one_and_start_as_frequencies():
    corpus, p = small_model()
    state = np.random.default_rng(0).standard_normal((1, gated_lm.HIDDEN)).astype(np.float32)
    for weights in (p, {k: v + 0.3 * np.random.default_rng(1).standard_normal(v.shape).astype(np.float32) for k, v in p.items()}):
        logs, _ = gated_lm.outputs(weights, corpus.bounds, np.repeat(state, 6, 0), np.arange(6))
        assert abs(np.exp(logs).sum() - 1) < 1e-5
    logs, _ = gated_lm.outputs(p, corpus.bounds, np.repeat(state, 6, 0), np.arange(6))
    mass = np.array([50.5, 40.5, 30.5, 9.5, 5.5, 66 + 13])
    assert np.allclose(np.exp(logs), mass / mass.sum(), atol=1e-6)


def plain_likelihood(p, bounds, end, words):
    """Log-probability of one text from the formulas of the unit and the two softmaxes, word by word."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    h, before, total, n = np.zeros(gated_lm.HIDDEN), end, 0.0, gated_lm.HIDDEN
    for word in words:
        x, rec = p["e"][before] @ p["x"] + p["b"], h @ p["u"]
        z, r = sigmoid(x[:n] + rec[:n]), sigmoid(x[n:2 * n] + rec[n:2 * n])
        h = (1 - z) * h + z * np.tanh(x[2 * n:] + r * rec[2 * n:])
        logit = lambda rows: np.exp(rows[:, :n] @ h + rows[:, n])
        k = max(i for i, b in enumerate(bounds) if b <= word)
        total += math.log(logit(p["c"])[k] / logit(p["c"]).sum())
        if k < len(bounds) - 1:
            inside = logit(p["w"][bounds[k]:bounds[k + 1]])
            total += math.log(inside[word - bounds[k]] / inside.sum())
        before = word
    return total


def random_model(seed, kind=np.float32):
    corpus, p = small_model()
    rng = np.random.default_rng(seed)
    return corpus, {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(kind) for k, v in p.items()}, rng


def test_gradients_equal_differences():
    corpus, p, rng = random_model(2, np.float64)
    words = rng.integers(0, 6, (6, 3))
    words[3, 1] = 1  # an end: the state starts anew behind it
    fed = np.vstack([rng.integers(0, 6, (1, 3)), words[:-1]])
    valid = np.ones((6, 3), bool)
    valid[4:, 2] = False
    h = 0.1 * rng.standard_normal((3, gated_lm.HIDDEN))

    def loss(q, learn=lambda *a: None):
        return -gated_lm.backpropagated(q, corpus.bounds, fed, words, valid, h, 1, learn)[1].sum()

    found = {k: np.zeros_like(v) for k, v in p.items()}

    def learn(name, rows, gradient):
        found[name][rows] += gradient

    loss(p, learn)
    for k, v in p.items():
        for place in [tuple(rng.integers(0, n) for n in v.shape) for _ in range(8)]:
            up, down = {**p, k: v.copy()}, {**p, k: v.copy()}
            up[k][place] += 1e-5
            down[k][place] -= 1e-5
            assert math.isclose(found[k][place], (loss(up) - loss(down)) / 2e-5, rel_tol=1e-4, abs_tol=1e-7), k


def test_likelihoods_equal_plain_ones(monkeypatch):
    corpus, p, rng = random_model(3)
    docs = [rng.integers(0, 6, n) for n in (1, 70, 33, 200, 32)]
    want = [plain_likelihood({k: v.astype(float) for k, v in p.items()}, corpus.bounds, 1, d) for d in docs]
    for together in (1 << 15, 7):
        monkeypatch.setattr(gated_lm, "SCORE_TOKENS", together)
        assert np.allclose(gated_lm.likelihoods(p, corpus.bounds, 1, docs), want, rtol=1e-4)
    assert len(gated_lm.likelihoods(p, corpus.bounds, 1, [])) == 0


def test_a_documents_state_ends_with_it():
    corpus, p, rng = random_model(4)
    docs = [np.append(rng.integers(2, 6, n), 1) for n in (5, 3, 8)]  # 1: the end
    stream = np.concatenate(docs)
    fed = np.concatenate([[1], stream[:-1]])[:, None]
    _, logs = gated_lm.backpropagated(p, corpus.bounds, fed, stream[:, None], np.ones(fed.shape, bool), np.zeros((1, gated_lm.HIDDEN), np.float32), 1,
                                      lambda *a: None)
    upto = np.cumsum([0, *map(len, docs)])
    alone = gated_lm.likelihoods(p, corpus.bounds, 1, docs)
    assert np.allclose([logs[a:b].sum() for a, b in zip(upto, upto[1:])], alone, rtol=1e-4)


def test_training_learns_what_follows_what_from_every_token():
    corpus, p = small_model()
    place = {w.encode(): i for i, w in enumerate(corpus.modelled)}
    doc = np.array([place[w] for w in b"the cat of dog ".split() * 40] + [place[b""]])
    trainer, first = gated_lm.Trainer(p, corpus.bounds, 1), gated_lm.likelihoods(p, corpus.bounds, 1, [doc])[0]
    for _ in range(6):
        trainer.read(np.tile(doc, 30))
    assert trainer.tokens == 6 * 30 * 161 and gated_lm.likelihoods(trainer.p, corpus.bounds, 1, [doc])[0] > 0.3 * first
    seen = []
    trainer.update = lambda name, rows, g: seen.append(g[:, -1].sum() if name == "c" else 0.0)
    one = gated_lm.backpropagated
    counted = []
    gated_lm.backpropagated = lambda *a: counted.append(int(a[4].sum())) or one(*a)
    try:
        trainer.read(np.tile(doc, 7)[:1013])  # no multiple of anything
    finally:
        gated_lm.backpropagated = one
    assert sum(counted) == 1013


def test_words_are_split_at_blanks_of_ascii_only():
    texts = ["", None, " ", "A b", "\x0ba\x0cB\r\n\tc ", "x\x1cy\x1fz \x85w\u00a0v\u2003u\u3000t", "\u00c4\u0130 I", "\x00a \x00", "tail\n"]
    words, ends = gated_lm.split(pa.array(texts, pa.string()).slice(1))
    words, upto = words.to_pylist(), [0, *ends.tolist()]
    assert [words[a:b] for a, b in zip(upto, upto[1:])] == [tokens(t)[:-1] for t in texts[1:]]
    assert gated_lm.places_of(pa.array(["b", "", "z", "a"]), pa.array(["a", "b", ""])).tolist() == [1, 2, 3, 0]


def test_a_window_moves_each_array_of_weights_once():
    corpus, p, rng = random_model(5)
    trainer, moved = gated_lm.Trainer(p, corpus.bounds, 1), Counter()
    update = trainer.update
    trainer.update = lambda name, *a: moved.update([name]) or update(name, *a)
    trainer.read(rng.integers(0, 6, gated_lm.WINDOW * gated_lm.SIDE_BY_SIDE * 3).astype(np.int32))
    assert moved == dict.fromkeys("exubcw", 3)  # however many classes there are


def test_an_update_is_the_plain_one():
    corpus, p, rng = random_model(6, np.float64)
    words = rng.integers(0, 6, 5 * gated_lm.WINDOW).astype(np.int32)
    trainer, found = gated_lm.Trainer(p, corpus.bounds, 1), {k: np.zeros_like(v) for k, v in p.items()}

    def learn(name, rows, gradient):
        found[name][rows] += gradient

    column = words.reshape(5, -1).T
    fed = np.concatenate([[1], words[:-1]]).reshape(5, -1).T
    gated_lm.backpropagated(p, corpus.bounds, fed, column, np.ones(fed.shape, bool), np.zeros((5, gated_lm.HIDDEN)), 1, learn)
    trainer.read(words)
    for k, v in p.items():
        g = np.clip(found[k] / 5, -gated_lm.CLIP, gated_lm.CLIP)
        want = v - gated_lm.RATE * g / np.sqrt(1e-2 + g * g)
        if k in "cw":
            want[:, :gated_lm.HIDDEN] = np.clip(want[:, :gated_lm.HIDDEN], -gated_lm.LARGEST, gated_lm.LARGEST)
        assert np.allclose(trainer.p[k], want, rtol=1e-5, atol=1e-6), k


def test_words_lie_by_columns_and_windows_are_the_plain_ones():
    corpus, p, rng = random_model(7, np.float64)
    trainer = gated_lm.Trainer(p, corpus.bounds, 1)
    assert trainer.p["w"].flags.f_contiguous and trainer.squares["w"].flags.f_contiguous
    words = rng.integers(0, 6, 5 * 3 * gated_lm.WINDOW - 7)  # the last row ends early
    # window by window, moved by gradients that are added up as they come
    plain, squares, rows = {k: v.copy() for k, v in p.items()}, {k: np.full_like(v, 1e-2) for k, v in p.items()}, len(words) // gated_lm.WINDOW
    length = -(-len(words) // rows)
    grid = np.append(words, [1] * (rows * length - len(words))).reshape(rows, length).T
    valid, fed = (np.arange(rows * length) < len(words)).reshape(rows, length).T, np.append(1, grid.T.ravel()[:-1]).reshape(rows, length).T
    h = np.zeros((rows, gated_lm.HIDDEN))
    for at in range(0, length, gated_lm.WINDOW):
        part, found = slice(at, at + gated_lm.WINDOW), {k: np.zeros_like(v) for k, v in p.items()}

        def learn(name, rows, gradient):
            np.add.at(found[name], rows, gradient)

        h, _ = gated_lm.backpropagated(plain, corpus.bounds, fed[part], grid[part], valid[part], h, 1, learn)
        for k, v in plain.items():
            g = np.clip(found[k] / rows, -gated_lm.CLIP, gated_lm.CLIP)
            squares[k] += g * g
            v -= gated_lm.RATE * g / np.sqrt(squares[k])
            if k in "cw":
                v[:, :gated_lm.HIDDEN] = np.clip(v[:, :gated_lm.HIDDEN], -gated_lm.LARGEST, gated_lm.LARGEST)
    trainer.read(words.astype(np.int32))
    for k, v in plain.items():
        assert np.allclose(trainer.p[k], v, rtol=1e-6, atol=1e-7), k


def test_likelihoods_of_odd_rows(spark, rows):
    docs = rows("doc_id long, text string, held_out boolean", (1, None, False), (2, "", True), (2, "", True), (3, LONG, False), (None, "a A b", False))
    own = docs.filter("not held_out")
    counts = gated_lm.word_counts(own)
    corpus = gated_lm.survey(counts)
    got = {(r.doc_id, r.n_tokens, r.n_known) for r in gated_lm.scored(docs, counts, corpus, gated_lm.start(corpus)).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (3, 60_001, 60_001), (None, 4, 4)}
    nothing = gated_lm.word_counts(docs.limit(0))
    empty = gated_lm.survey(nothing)
    weights = gated_lm.train(docs.limit(0), empty)
    scored = {(r.doc_id, r.n_known): r.base_score for r in gated_lm.scored(docs, nothing, empty, weights).collect()}
    assert scored[(None, 0)] == 0.0 and empty.tokens == 0
    assert gated_lm.scored(docs.limit(0), counts, corpus, weights).count() == 0


def test_words_beyond_the_head_meet_their_counts(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    counts = gated_lm.saved(gated_lm.word_counts(docs), "word-counts")
    whole = gated_lm.survey(counts)
    monkeypatch.setattr(gated_lm, "HEAD", 50)
    few = gated_lm.survey(counts)
    assert len(few.head) <= 51 and ("", docs.count()) in few.head and few.tokens == whole.tokens
    want = {r.doc_id: r for r in gated_lm.scored(docs, counts, whole, gated_lm.start(whole)).collect()}
    for r in gated_lm.scored(docs, counts, few, gated_lm.start(few)).collect():
        assert r.n_known == want[r.doc_id].n_known and math.isclose(r.base_score, want[r.doc_id].base_score, rel_tol=1e-9)


def test_training_reads_every_document(rows):
    docs = rows("doc_id long, text string", *[(i, f"own{i} the cat") for i in range(40)]).repartition(3)
    corpus = gated_lm.survey(gated_lm.word_counts(docs))
    weights, first = gated_lm.train(docs, corpus), gated_lm.start(corpus)
    alone = {a for a, b in zip(corpus.bounds, corpus.bounds[1:]) if b - a == 1}  # a class of one word has nothing to learn inside
    own = {corpus.modelled.index(f"own{i}") for i in range(40)} - alone
    assert len(own) > 30 and all(np.any(weights["w"][i] != first["w"][i]) for i in own)  # each was looked for in some update


def test_classes_cover_the_words_that_are_frequent_enough(rows, monkeypatch):
    text = " ".join(f"w{i} " * (400 // (i + 1)) for i in range(300))
    counts = gated_lm.word_counts(rows("doc_id long, text string", (1, text)))
    corpus = gated_lm.survey(counts)
    assert corpus.bounds[0] == 0 and corpus.bounds[-1] == len(corpus.modelled) == len(corpus.head) and corpus.rest_tokens == 0
    assert all(a < b for a, b in zip(corpus.bounds, corpus.bounds[1:])) and len(corpus.bounds) > 8
    monkeypatch.setattr(gated_lm, "SHARE", 100)
    fewer = gated_lm.survey(counts)
    assert len(fewer.modelled) < 30 and fewer.rest_tokens > 0 and "" in fewer.modelled
    assert all(n * 100 >= fewer.tokens for w, n in fewer.head if w in fewer.modelled and w)
