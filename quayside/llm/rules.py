"""Quality rules as a learned decision list, with DataFrame functions only.

Statistics of each whole text are computed in its row. A decision list is then
learned from labelled rows by sequential covering: a rule is a conjunction of
thresholds (statistic > t, or <= t) that grows by the condition with the best
information gain, is pruned back to the prefix that does best on rows held out
from growing, and is kept if enough of the rows it fires on there are bad; the
rows it covers are set aside, and the next rule is grown on the rest. The list
becomes one ordered Spark conditional expression. Growing and pruning only ever
see counts by statistic and threshold (thresholds lie midway between quantiles), summed by
Spark over all labelled rows: neither rows nor labels go to the driver.

Defined results: a null text counts as empty, has no words, and fails the base
rule; repeated rows get equal verdicts, repeated labels count each time; null
labels and labels without a document do not count; without labels of both
kinds, or in an empty table, the list is empty and keeps what passes the base
rule; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame, functions as F

from quayside.llm.common import WORD, bound, fold, read, saved, text_of, words_of

WINDOW = 8  # words
SYMBOLS = r"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
QUANTILES = 40  # thresholds tried per statistic
MAX_CONDITIONS, MAX_RULES = 4, 24
PRUNE_FOLD = 3  # one row in three is held out from growing
MIN_PRECISION, MIN_BAD = 0.6, 5  # a rule must hold this much on the rows held out


def _others(text: Column, chars: str) -> Column:
    """How many characters of the set there are."""
    return F.char_length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of 8 words that occur twice or more."""
    def of(words):
        prints = F.when(F.size(words) >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))))
        return bound(prints, lambda p: F.when(
            p.isNull() | (F.size(F.array_distinct(p)) == F.size(p)), F.lit(0)).otherwise(covered(p)))

    def covered(prints):
        ordered = F.sort_array(F.transform(prints, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return bound(ordered, lambda o: bound(F.sort_array(F.transform(F.filter(o, lambda e, k: (
            (k > 0) & (F.get(o, k - 1)["x"] == e["x"])) | ((k < F.size(o) - 1) & (F.get(o, k + 1)["x"] == e["x"]))),
            lambda e: e["i"])), union))

    def union(places):
        steps = F.transform(places, lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, s: total + s)

    return bound(words, of).cast("long")


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id and counts over its whole text."""
    split = docs.select(F.col(id).alias("doc_id"), text_of(text).alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    return split.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _others(F.col("text"), SYMBOLS).alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        _others(F.col("text"), r"\p{Lu}").alias("n_upper"), _others(F.col("text"), "!?").alias("n_marks"),
        _others(F.col("text"), "0-9").alias("n_digits"), _others(F.col("text"), "\n").alias("n_breaks"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(count: str, of: str) -> Column:
    return F.col(count) / F.greatest(F.col(of), F.lit(1))


# statistics that rules may name
FEATURES = {
    "words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: _share("word_chars", "n_words"),
    "symbol_share": lambda: _share("n_symbols", "word_chars"),
    "upper_share": lambda: _share("n_upper", "word_chars"),
    "mark_share": lambda: _share("n_marks", "n_words"),
    "digit_share": lambda: _share("n_digits", "word_chars"),
    "dup_line_share": lambda: F.col("n_dup_lines") / (F.col("n_breaks") + 1),
    "repeat_share": lambda: _share("n_repeat_words", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _all(conditions) -> Column:
    found = F.lit(True)
    for c in conditions:
        found = found & c.column()
    return found


def _gain(p: int, n: int, before_p: int, before_n: int) -> float:
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(before_p / (before_p + before_n)))


def _best_condition(rows: DataFrame, thresholds: dict[str, list[float]], given: int, not_given: int):
    """The condition that gains most on `rows`, with what it leaves, from counts by statistic and threshold."""
    places = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"b{i}").alias("b")) for i in range(len(thresholds))])
    counts = rows.select("bad", "good", F.explode(places).alias("at")).groupBy("at.f", "at.b").agg(
        F.sum("bad").alias("p"), F.sum("good").alias("n")).collect()  # statistics x thresholds at most
    best = None
    for i, (feature, cuts) in enumerate(thresholds.items()):
        at = {r.b: (r.p, r.n) for r in counts if r.f == i}
        p = n = 0
        for k, t in enumerate(cuts):
            p, n = p + at.get(k, (0, 0))[0], n + at.get(k, (0, 0))[1]
            for above, (cp, cn) in ((False, (p, n)), (True, (given - p, not_given - n))):
                gain = _gain(cp, cn, given, not_given)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, Condition(feature, above, t), cp, cn
    return best


def _exceeded(value: Column, cuts: list[float]) -> Column:
    """How many of the thresholds the value is above."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda t: value > t))


def learn(labelled: DataFrame) -> list[list[Condition]]:
    """Rules for bad rows, in order. `labelled`: doc_id, the statistics, and quality (0 bad, 1 good)."""
    quantiles = [(i + 1) / (QUANTILES + 1) for i in range(QUANTILES)]
    found = labelled.agg(*[F.percentile_approx(f(), quantiles, 1000).alias(n) for n, f in FEATURES.items()]).first()
    values = {n: sorted(set(found[n] or [])) for n in FEATURES}
    thresholds = {n: [(a + b) / 2 for a, b in pairwise(v)] for n, v in values.items()}
    # rows alike in every comparison are one row with counts
    places = [_exceeded(FEATURES[n](), cuts).alias(f"b{i}") for i, (n, cuts) in enumerate(thresholds.items())]
    names = [f"b{i}" for i in range(len(thresholds))]
    cells = saved(labelled.select(*places, (fold("doc_id", PRUNE_FOLD) == 0).alias("held"), "quality").groupBy(
        *names, "held").agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count_if(F.col("quality") == 1).alias("good")),
        "rule-cells")

    def holds(condition: Condition) -> Column:
        i, k = list(thresholds).index(condition.feature), thresholds[condition.feature].index(condition.threshold)
        return F.col(f"b{i}") > k if condition.above else F.col(f"b{i}") <= k

    def held_by(conditions) -> Column:
        found = F.lit(True)
        for c in conditions:
            found = found & holds(c)
        return found

    rules: list[list[Condition]] = []
    left = cells
    while len(rules) < MAX_RULES:
        rows, rule = left.filter("not held"), []
        total = rows.agg(F.sum("bad").alias("p"), F.sum("good").alias("n")).first()
        p, n = total.p or 0, total.n or 0
        while p and n and len(rule) < MAX_CONDITIONS:
            best = _best_condition(rows, thresholds, p, n)
            if best is None:
                break
            _, condition, p, n = best
            rule.append(condition)
            rows = rows.filter(holds(condition))
        if not rule:
            break
        prefixes = [held_by(rule[:k + 1]) for k in range(len(rule))]
        worth = left.filter("held").agg(*[F.sum(F.when(c, F.col(kind))).alias(f"{kind}{k}")
                                          for k, c in enumerate(prefixes) for kind in ("bad", "good")]).first()
        scored = [(worth[f"bad{k}"] or 0, worth[f"good{k}"] or 0) for k in range(len(rule))]
        k = max(range(len(rule)), key=lambda k: ((scored[k][0] - scored[k][1]) / max(1, sum(scored[k])), scored[k][0], -k))
        bad, good = scored[k]
        if bad < MIN_BAD or bad < MIN_PRECISION * (bad + good):
            break
        rules.append(rule[:k + 1])
        left = left.filter(~held_by(rule[:k + 1]))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one ordered conditional: false at the first rule that fires, else true."""
    found = F.lit(True)
    for rule in reversed(rules):
        found = F.when(_all(rule), F.lit(False)).otherwise(found)
    return found


def op9_quality_rules(spark, sf_dir):
    counts = saved(statistics(read(spark, sf_dir, "documents")), "statistics")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").filter("quality in (0, 1)")
    rules = learn(counts.filter(~base_failed()).join(labels, "doc_id"))  # the list only speaks where the base passes
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLE: dict[str, str] = {}
