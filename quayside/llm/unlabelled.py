"""Quality of documents, learned from trusted positives and unlabelled text.

Statistics of each whole text are taken in its task. A text is described by
where each statistic lies between knots (quantiles over all documents), so the
model is a sum of piecewise linear functions of them, and a score is its
logistic.

Learning knows documents labelled good, and all documents as an unlabelled
mixture of good and bad ones; labels of bad ones are not used. A first model
tells the two sets apart, on one half of the documents. On the other half, the
share of unlabelled over the share of positives above a threshold is at least
the class prior, and equals it where only good documents are left: the prior is
taken at the threshold with the best upper bound. The second model minimises
the non-negative unbiased risk: with prior p and logistic loss,

    p E+[loss(z, +)] + max(0, E[loss(z, -)] - p E+[loss(z, -)])

by damped Newton steps; a step that lowers what is under the maximum below zero
is halved, as the risk of bad documents cannot be negative. Each step is one
pass over the statistics of all documents; sums of gradients are added up by
tasks before they reach the driver.

Defined results: a null text counts as empty; empty texts are scored like any;
rows that repeat an id share its label, and each is scored; of several labels
of one id the largest holds; null labels, and labels outside 0 and 1, are none;
without positives every score is 0.5; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import fold, read, saved, slices, summed
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

HELD_FOLDS, HELD = 3, 1
KNOTS = 12  # of a statistic, at most
STEPS = 12  # Newton steps of a model, at most
RIDGE = 10.0  # over the number of positives
LEVELS = 32  # of the first model's score to one unit of its logit
THRESHOLD = 0.5
CONFIDENCE = 0.1  # chance that the prior's upper bound fails

# Characters that are counted.
SYMBOLS = b"#*$%&|<>=+~^_\\/@{}[]"
MARKS = b"!?"
STOPS = b".,;:"

STATISTICS = ("words", "word_length", "distinct_words", "top_word", "same_as_last", "distinct_triples", "symbols", "capitals", "digits",
              "marks", "stops", "same_lines", "line_words", "beyond_ascii")


def statistics_of(text: str) -> list[float]:
    """The statistics of a whole text."""
    from collections import Counter

    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    most = Counter(words).most_common(1)
    triples = max(1, n - 2)
    per_word = max(1, n)
    return [
        math.log1p(n), sum(map(len, words)) / per_word, len(set(words)) / per_word, (most[0][1] if most else 0) / per_word,
        sum(a == b for a, b in zip(words, words[1:])) / per_word, len(set(zip(words, words[1:], words[2:]))) / triples,
        without(SYMBOLS) / size, without(bytes(range(65, 91))) / size, without(bytes(range(48, 58))) / size,
        without(MARKS) / per_word, without(STOPS) / per_word, 1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(n / max(1, len(lines))), without(bytes(range(128, 256))) / size]


def described(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the statistics of each row of `docs`."""
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, "text"):
            found = [statistics_of(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<double>")


def knots_of(rows: DataFrame) -> list[list[float]]:
    """Per statistic: zero, and quantiles over its values that are not zero."""
    shares = [(i + 0.5) / (KNOTS - 1) for i in range(KNOTS - 1)]
    found = rows.agg(*[F.percentile_approx(F.when(F.get("x", F.lit(i)) != 0, F.get("x", F.lit(i))), shares, 1000).alias(s)
                       for i, s in enumerate(STATISTICS)]).first()
    return [sorted({0.0, *(found[s] or [])}) for s in STATISTICS]


def basis(x, knots: list[list[float]]):
    """Rows by features: for each statistic, how near it is to each knot (piecewise linear, one in sum), and a one."""
    import numpy as np

    columns = []
    for i, at in enumerate(knots):
        places = np.interp(x[:, i], at, np.arange(len(at)))
        columns.append(np.maximum(0.0, 1 - np.abs(places[:, None] - np.arange(len(at)))))
    return np.column_stack([*columns, np.ones(len(x))])


def _arrays(batch):
    """Statistics and the number of positives of each row."""
    import numpy as np

    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy().reshape(len(x), -1), batch.column(batch.schema.get_field_index("good")).to_numpy(zero_copy_only=False).astype(np.float64)


@dataclass
class Sums:
    """Over unlabelled rows and positives: sums that both risks and their derivatives are made of."""
    rows: float
    good: float
    unlabelled_minus: float  # loss of unlabelled rows as if bad
    good_minus: float  # loss of positives as if bad
    good_plus: float
    unlabelled_slope: object  # features: sum of sigmoid(z) over unlabelled rows
    good_sum: object
    good_slope: object  # sum of sigmoid(z) over positives
    curve: object  # features x features, of unlabelled rows
    good_curve: object


def passed(rows: DataFrame, knots: list[list[float]], w) -> Sums:
    """One pass over `rows` (x, good) with weights w."""
    import numpy as np

    m = len(w)

    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, good = _arrays(batch)
            b = basis(x, knots)
            z = b @ w
            minus, p = np.logaddexp(0, z), 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            bend, at = p * (1 - p), good > 0
            own = np.concatenate([
                [len(b), good.sum(), minus.sum(), good @ minus, good @ (minus - z)], b.T @ p, b.T @ good, b.T @ (good * p),
                ((b * bend[:, None]).T @ b).ravel(), ((b[at] * (good * bend)[at, None]).T @ b[at]).ravel()])
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    s = summed(rows.select("x", "good").mapInArrow(run, "sums binary"))
    if s is None:
        s = np.zeros(5 + 3 * m + 2 * m * m)
    a = 5 + 3 * m
    return Sums(*s[:5], *s[5:a].reshape(3, m), *s[a:].reshape(2, m, m))


def told_apart(s: Sums):
    """(risk, gradient, curvature, 0): logistic loss of telling positives from unlabelled rows, both of equal weight."""
    n, g = max(1.0, s.rows), max(1.0, s.good)
    return (s.good_plus / g + s.unlabelled_minus / n, s.unlabelled_slope / n + (s.good_slope - s.good_sum) / g,
            s.curve / n + s.good_curve / g, 0.0)


def unbiased(prior: float):
    """The non-negative unbiased risk of a class prior; last, what is under the maximum."""
    def of(s: Sums):
        n, g = max(1.0, s.rows), max(1.0, s.good)
        bad = s.unlabelled_minus / n - prior * s.good_minus / g
        return prior * s.good_plus / g + max(0.0, bad), s.unlabelled_slope / n - prior * s.good_sum / g, s.curve / n, bad

    return of


def minimised(rows: DataFrame, knots: list[list[float]], risk, bias: float = 0.0):
    """Weights that minimise `risk`, by damped Newton steps that never take its last part below zero."""
    import numpy as np

    w = np.zeros(sum(map(len, knots)) + 1)
    w[-1] = bias
    s = passed(rows, knots, w)
    ridge = RIDGE / max(1.0, s.good)
    held = np.full(len(w), ridge)
    held[-1] = 0.0
    value, slope, curve, _ = risk(s)
    value += 0.5 * held @ (w * w)
    length, moved = 1.0, None
    for _ in range(STEPS):
        if moved is None:
            moved = -np.linalg.solve(curve + np.diag(held + 1e-9), slope + held * w)
        trial = w + length * moved
        found, slope2, curve2, bad = risk(passed(rows, knots, trial))
        found += 0.5 * held @ (trial * trial)
        if bad < 0 or found > value + 1e-12:
            length /= 2
            if length < 1e-3:
                break
            continue
        gained, w, value, slope, curve, moved, length = value - found, trial, found, slope2, curve2, None, min(1.0, 2 * length)
        if gained < 1e-6:
            break
    return w


def judged(rows: DataFrame, knots: list[list[float]], w) -> DataFrame:
    """`rows` (doc_id, x, ...) as doc_id and logit."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = batch.column(1)
            z = basis(x.flatten().to_numpy().reshape(len(x), -1), knots) @ w if len(x) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.float64())], names=["doc_id", "logit"])

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, logit double")


def prior_of(rows: DataFrame, knots: list[list[float]], w) -> float:
    """The share of good documents among `rows` (x, good), by the first model's weights."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, good = _arrays(batch)
            z = basis(x, knots) @ w if len(x) else np.zeros(0)
            level = np.clip(np.round(z * LEVELS), -16 * LEVELS, 16 * LEVELS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(level), pa.array(good)], names=["level", "good"])

    table = rows.select("x", "good").mapInArrow(run, "level long, good double").groupBy("level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")).orderBy(F.desc("level")).collect()  # a row per level
    above, above_good = np.cumsum([r.n for r in table], dtype=float), np.cumsum([r.good for r in table])
    if not len(table) or not above_good[-1]:
        return 0.5
    n, g = above[-1], above_good[-1]
    shares, good_shares = above / n, np.maximum(above_good / g, 1e-12)
    room = math.sqrt(math.log(4 / CONFIDENCE) / (2 * n)) + math.sqrt(math.log(4 / CONFIDENCE) / (2 * g))
    best = int(np.argmin((shares + room) / good_shares))
    return float(np.clip(shares[best] / good_shares[best], 0.01, 0.99))


@dataclass
class Model:
    knots: list[list[float]]
    weights: object  # None without positives
    prior: float


def fit(rows: DataFrame) -> Model:
    """The model of `rows` (doc_id, x, good: 1 for a trusted positive, else 0), all of which are the unlabelled mixture."""
    knots = knots_of(rows)
    if not rows.filter("good = 1").limit(1).count():
        return Model(knots, None, 0.5)
    half = F.pmod(F.xxhash64("doc_id", F.lit("prior")), F.lit(2)) == 0
    prior = prior_of(rows.filter(~half), knots, minimised(rows.filter(half), knots, told_apart))
    return Model(knots, minimised(rows, knots, unbiased(prior), math.log(prior / (1 - prior))), prior)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of each row."""
    if model.weights is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    return judged(rows, model.knots, model.weights).select("doc_id", (1 / (1 + F.exp(-F.col("logit")))).alias("score"))


def with_positives(rows: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """`rows` with good: whether a label that may be learned from says so."""
    known = labels.filter(F.col(label).isin(0, 1) & (fold("doc_id", HELD_FOLDS) != HELD)).groupBy(
        F.col("doc_id").cast("long").alias("_of")).agg(F.max(label).alias("good"))
    return rows.join(known, F.col("doc_id") == F.col("_of"), "left").select("doc_id", "x", F.coalesce("good", F.lit(0)).cast("int").alias("good"))


def op13_quality_classifier(spark, sf_dir):
    rows = saved(described(read(spark, sf_dir, "documents")), "quality-statistics")
    marked = saved(with_positives(rows, read(spark, sf_dir, "labels")), "quality-rows")
    return scored(rows, fit(marked)).select(
        "doc_id", (fold("doc_id", HELD_FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op13_quality_classifier": op13_quality_classifier}
ORACLE: dict[str, str] = {}
