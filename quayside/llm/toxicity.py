"""Toxicity of whole texts after undoing disguised spelling.

Noisy channel: a disguised word was spelled out plainly and then some letters
were swapped for look-alikes, doubled, or set apart. Each odd token becomes a
lattice of the letters its characters may stand for, and Viterbi search finds
the likeliest path under a character language model (four letters, smoothed
with shorter ones) counted over all documents. The search is exact: a state is
the last three symbols, and nothing is cut. Odd are tokens of letters that hold
a look-alike or a separator at any place, or a letter three times in a row, and
three single characters or more in a row, between which words may end; a run
of any length is read whole, a word between two pieces of it in the later one.
A token that plain marks join, or a long one, is read word by word. Stars
stand for a letter each, up to `MASKS` in a row; more are a ruler. A token of
more than `LONGEST` characters, a repeated letter counted once, is no disguised word.

Score: words of the restored text that speak for toxicity are learned from
labelled rows: the rate among toxic documents against the others, for words
that stand in several different surroundings, so that copies of one text count
little. A logistic model on how strong, how many and how dense they are gives
the score. All labelled rows outside the held-out fold are learned from.

Defined results: a null text counts as empty; a text without words scores as
one without toxic words; repeated rows score alike; labels other than 0 and 1
are not read; without labels of both kinds every score is the smoothed rate;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left

from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import fold, read, saved, slices, summed
from quayside.llm.disclosure import Terms, bitmap
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

HELD_FOLDS, HELD = 3, 1
ORDER, SYMBOLS = 4, 28  # a to z, other letters, anything else
MIN_PLACES, MIN_LOG_ODDS = 3, 2.0
THRESHOLD = 0.7
TABLE = 200_000  # tokens remembered by a task
PARTS = 4  # one part of the clean rows is counted first

# Characters and the letters they are written for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i",
}
# Characters put between letters.
SEPARATORS = ".-_*~'` "
SWAP, DROP, DOUBLE, LEAVE, MASK = -2.0, -0.5, -0.7, -4.0, -4.0  # log-costs of the channel
MASKS, LONGEST = 4, 64  # stars that stand for letters, in a row; characters of a disguised word


def symbols(text: str):
    """Symbol of each character: 0 nothing of a word, 1 to 26 a letter, 27 another letter."""
    import numpy as np

    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.zeros(0x250, np.int32)
    table[97:123] = np.arange(1, 27)
    table[0xC0:] = 27
    return np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], 27)


def letter_counts(docs: DataFrame, text: str = "text"):
    """Counts of letter quadruples over all documents, an array of SYMBOLS ** ORDER."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        sums = np.zeros(SYMBOLS ** ORDER, np.int64)
        for batch in slices(batches, text):
            joined = " " * ORDER + (" " * ORDER).join(t for t in batch.column(0).to_pylist() if t) + " "
            s = symbols(joined)
            s = s[~((s == 0) & (np.roll(s, 1) == 0) & (np.roll(s, 2) == 0) & (np.roll(s, 3) == 0))]  # blanks once are enough
            if len(s) >= ORDER:
                at = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
                sums += np.bincount(at, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    rows = docs.select(text).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS ** ORDER)
    counts[rows["at"].to_numpy(int)] = rows["n"]
    return counts


def letter_logs(counts):
    """log p(symbol | three before it), each order smoothed with the next shorter one."""
    import numpy as np

    cube = counts.reshape([SYMBOLS] * ORDER)
    p = (cube.sum((0, 1, 2)) + 1) / (cube.sum() + SYMBOLS)
    for axes in ((0, 1), (0,), ()):
        part = cube.sum(axes) if axes else cube
        p = (part + 20.0 * p) / (part.sum(-1, keepdims=True) + 20.0)
    return np.log(p).astype(np.float32).reshape(-1, SYMBOLS)


def repeated(letter: str, length: int, cost: float) -> list[tuple[str, float]]:
    """A run of a letter stands for one or, if there are two at least, for two."""
    if length == 1:
        return [(letter, cost)]
    return [(letter, cost + DOUBLE * length), (letter * 2, cost + (DOUBLE * (length - 1) if length > 2 else 0.0))]


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """What each stretch of a lower-case token may stand for, and its log-cost in the channel.

    A blank is a word's end or nothing; one to `MASKS` stars are a letter each, or nothing.
    """
    steps, i = [], 0
    while i < len(token):
        run = i
        while run < len(token) and token[run] == token[i]:
            run += 1
        c, length = token[i], run - i
        i = run
        if c == " ":
            steps.append([(" ", 0.0), ("", 0.0)])
        elif c.isalpha():
            steps.append(repeated(c, length, 0.0))
        elif c == "*" and length <= MASKS:
            steps += [[("", DROP), *[(chr(97 + k), MASK) for k in range(26)]]] * length
        else:
            options = [o for letter in LOOK_ALIKES.get(c, "") for o in repeated(letter, length, SWAP * length)]
            steps.append([*options, ("", (LEAVE if c.isdigit() else DROP) * length)])
    return steps


def arc(state: tuple, option: tuple[str, float], logs) -> tuple[tuple, float]:
    """The state behind an option, and what the option costs from this state: channel and letters. A state is the last three symbols and letter."""
    (a, b, d, last), (letters, cost) = state, option
    if cost < 0 and len(letters) == 1 and letters == last:  # a disguised letter that repeats the last one
        cost += DOUBLE
    for letter in letters:
        s = 0 if letter == " " else ord(letter) - 96 if "a" <= letter <= "z" else 27
        cost += float(logs[(a * SYMBOLS + b) * SYMBOLS + d][s])
        a, b, d, last = b, d, s, letter
    return (a, b, d, last), cost


def search(token: str, logs) -> tuple[str, int]:
    """The likeliest plain spelling of a lower-case token, words blank-joined, and behind how many of its blanks the last word begins.

    Exact search through the token's lattice; the number is 0 where no blank ends a word.
    """
    paths, blanks = {(0, 0, 0, ""): (0.0, "", 0)}, 0
    for options in lattice(token):
        found: dict = {}
        blanks += options[0][0] == " "
        for state, (score, path, begun) in paths.items():
            for option in options:
                key, cost = arc(state, option, logs)
                old = found.get(key)
                if old is None or (-(score + cost), path + option[0]) < (-old[0], old[1]):
                    found[key] = score + cost, path + option[0], blanks if option[0] == " " else begun
        paths = found
    ends = [(-(score + float(logs[(a * SYMBOLS + b) * SYMBOLS + d][0])), path, begun) for (a, b, d, _), (score, path, begun) in paths.items()]
    return min(ends)[1].strip(), min(ends)[2]


def restore(token: str, logs) -> str:
    """The likeliest plain spelling of a lower-case token, words blank-joined."""
    return search(token, logs)[0]


class Reader:
    """Words of a text with disguised ones restored. Remembers the tokens it has seen, up to a limit."""

    def __init__(self, logs):
        self.logs, self.words, self.runs = logs, {}, {}
        marks = "".join(map(re.escape, {*LOOK_ALIKES, *SEPARATORS.strip()}))
        # a look-alike or separator in it, or a letter three times in a row
        self.odd = re.compile(rf"[{marks}]|([^\W\d_])\1\1")
        self.plain = re.compile(r"[^\W_]+")
        self.again = re.compile(r"([^\W\d_])\1+")

    @staticmethod
    def core(token: str) -> str:
        """A token without the plain marks around it; each character is looked at once."""
        start, end = 0, len(token)
        while start < end and not token[start].isalnum() and token[start] not in LOOK_ALIKES:
            start += 1
        while end > start and not token[end - 1].isalnum() and token[end - 1] not in LOOK_ALIKES:
            end -= 1
        return token[start:end]

    def word(self, token: str) -> str:
        """Restored words of a lower-case token, blank-joined, "" if it holds none."""
        core = token if token.isalpha() else self.core(token)
        if core.isalpha() and not self.odd.search(core):
            return core
        if self.disguised(core):
            return restore(core, self.logs)
        # all words of what plain marks join, or of a long token
        return " ".join(restore(w, self.logs) if self.disguised(w) else w for w in self.plain.findall(core))

    def disguised(self, word: str) -> bool:
        short = len(word) <= LONGEST or len(self.again.sub(r"\1", word)) <= LONGEST
        return short and bool(self.odd.search(word)) and any(map(str.isalpha, word))

    def known(self, token: str) -> str:
        found = self.words.get(token)
        if found is None:
            if len(self.words) >= TABLE:
                self.words.clear()
            found = self.words[token] = self.word(token)
        return found

    def spaced(self, tokens: list[str]) -> list[tuple[int, int, str]]:
        """(start, end, words) of three or more single characters in a row, plain marks around them or not."""
        import numpy as np

        short = np.fromiter(map(len, tokens), np.int64, len(tokens)) <= 3
        if short.sum() < 3:
            return []
        single = np.zeros(len(tokens) + 2, np.int8)
        for i in np.flatnonzero(short).tolist():
            single[i + 1] = len(tokens[i]) == 1 or len(self.core(tokens[i])) == 1
        edges = np.flatnonzero(np.diff(single))
        found = []
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < 3:
                continue
            at, letters = start, [i for i in range(start, end) if any(map(str.isalpha, tokens[i]))]
            while at < end:  # a longer run is read piece by piece; the word that a piece may cut begins the next one
                first = bisect_left(letters, at)
                if first == len(letters):
                    break
                at = max(at, letters[first] - LONGEST // 2)  # what is farther from a letter is no word
                to = min(end, at + LONGEST)
                joined = " ".join(self.core(t) or t for t in tokens[at:to])
                key = joined, to < end
                if key not in self.runs:
                    if len(self.runs) >= TABLE:
                        self.runs.clear()
                    self.runs[key] = search(joined, self.logs) if to < end else (restore(joined, self.logs), 0)
                words, begun = self.runs[key]
                if begun:
                    words, to = words.rpartition(" ")[0], at + begun
                found.append((at, to, words))
                at = to
        return found

    def text(self, text: str) -> list[str]:
        """The restored text, word by word."""
        tokens = text.lower().split()
        runs, words, at = self.spaced(tokens), [], 0
        for start, end, some in runs:
            words += [*self.each(tokens[at:start]), *some.split(" ")]
            at = end
        return [*words, *self.each(tokens[at:])]

    def each(self, tokens: list[str]) -> list[str]:
        return [w for t in tokens for w in self.known(t).split(" ")]


def restored(docs: DataFrame, ids: DataFrame, logs) -> DataFrame:
    """doc_id and the restored text, words blank-joined and deflated, of `docs` (doc_id, text) whose ids are among `ids` (doc_id), and of few others."""
    kind = docs.schema["doc_id"].dataType
    as_text = F.col("doc_id").cast(kind).cast("string")
    sent = bitmap(ids.select(as_text.alias("term")))

    def run(batches):
        import pyarrow as pa

        reader, among = Reader(logs), Terms(sent.value, False)
        for batch in slices(batches, "text"):
            some = batch.filter(pa.array([i is not None and among.holds(i) for i in batch.column(1).to_pylist()], pa.bool_()))
            texts = [zlib.compress(" ".join(filter(None, reader.text(t or ""))).encode(), 1) for t in some.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(texts, pa.binary())], names=["doc_id", "restored"])

    return docs.select("doc_id", as_text.alias("id"), "text").mapInArrow(run, f"doc_id {kind.simpleString()}, restored binary")


def _words(raw) -> list[str]:
    return zlib.decompress(raw.as_buffer()).decode().split(" ")


def surroundings(rows: DataFrame, name: str, among: DataFrame | None = None) -> DataFrame:
    """w, and under `name` how many different words stand before it in `rows` (restored): of the words `among` (w), and few others, or of all.

    A word of one copied text has one surrounding, however many copies there are.
    """
    sent = bitmap(among.select(F.col("w").alias("term"))) if among is not None else None

    def run(batches):
        import pyarrow as pa

        of, asked = Terms(sent.value, False) if sent is not None else None, {}
        for batch in slices(batches, "restored", 1 << 18):
            found = set()
            for raw in batch.column(0):
                words = _words(raw)
                found.update(zip(words, ["", *words]))
            if of is not None:
                if len(asked) > TABLE:
                    asked.clear()
                asked.update((w, of.holds(w)) for w in {w for w, _ in found} - asked.keys())
            found = [x for x in found if len(x[0]) > 1 and (of is None or asked[x[0]])]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], names=["w", "before"])

    return rows.select("restored").mapInArrow(run, "w string, before string").distinct().groupBy("w").agg(F.count(F.lit(1)).alias(name))


def _signals(words: list[str], lexicon: dict[str, float]) -> list[float]:
    """How strong, how many, how dense."""
    hits = [lexicon[w] for w in words if w in lexicon]
    return [max(hits, default=0.0), math.log1p(len(hits)), math.sqrt(len(hits) / max(1, len(words)))]


def fit(docs: DataFrame, labels: DataFrame, logs):
    """Lexicon and logistic weights from all labelled rows outside the held-out fold."""
    learnable = fold("doc_id", HELD_FOLDS) != HELD
    own = labels.filter(F.col("toxic").isin(0, 1) & learnable & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    # texts without a label stay where they are
    rows = saved(restored(docs.select("doc_id", "text").filter(learnable), own, logs).join(own, "doc_id").select(
        "toxic", "restored"), "toxicity-rows")

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(_words(r)) for r in batch.column(1)], pa.int64())], names=["toxic", "words"])

    totals = {r.toxic: r for r in rows.mapInArrow(count, "toxic int, words long").groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).collect()}
    bad, good = [totals[t].n if t in totals else 0 for t in (1, 0)]
    rate = (bad + 0.5) / (bad + good + 10.0)
    if not bad or not good:
        return {}, [math.log(rate / (1 - rate)), 0.0, 0.0, 0.0]
    clean = rows.filter("toxic = 0")
    often = saved(surroundings(rows.filter("toxic = 1"), "a").filter(F.col("a") >= MIN_PLACES), "toxicity-words")
    odds = F.log((F.col("a") + 0.5) / (totals[1].words + 1)) - F.log((F.col("b") + 0.5) / (totals[0].words + 1))

    def speaking(words: DataFrame, against: DataFrame) -> DataFrame:
        return words.join(against, "w", "left").fillna(0, ["b"]).withColumn("odds", odds).filter(
            (F.col("odds") >= MIN_LOG_ODDS) & (F.col("a") > F.col("b")))

    # a word that has too many clean surroundings in some of the rows has too many in all: only the others are counted in all
    some = clean.filter(F.pmod(F.xxhash64("restored"), F.lit(PARTS)) == 0)
    left = saved(speaking(often, surroundings(some, "b", often)).select("w", "a"), "toxicity-candidates")
    lexicon = {r.w: r.odds for r in speaking(left, surroundings(clean, "b", left)).select("w", "odds").collect()}  # a vocabulary at most
    # a doubled letter may have been lost on the way
    lexicon = {re.sub(r"(.)\1", r"\1", w): o for w, o in lexicon.items()} | lexicon

    def signals(batches):
        import pyarrow as pa

        for batch in batches:
            found = [[t, *_signals(_words(r), lexicon)] for t, r in zip(batch.column(0).to_pylist(), batch.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array([float(f[i]) for f in found]) for i in range(4)], names=["y", "a", "b", "c"])

    cells = ["y", "a", "b", "c"]
    return lexicon, logistic(saved(rows.mapInArrow(signals, ", ".join(f"{c} double" for c in cells)).groupBy(cells).agg(
        F.count(F.lit(1)).alias("n")).sortWithinPartitions(cells), "toxicity-signals"))


def logistic(table: DataFrame) -> list[float]:
    """Weights of one, a, b and c for y, of `table` (y, a, b, c, n: how many), held down a little. Tasks make the sums of a step."""
    import numpy as np

    hold = np.array([1e-3, 0.1, 0.1, 0.1])

    def sums(w):
        def run(batches):
            import pyarrow as pa

            slope, hess = np.zeros(4), np.zeros((4, 4))
            for batch in batches:
                y, a, b, c, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
                x = np.column_stack([np.ones(len(y)), a, b, c])
                p = 1 / (1 + np.exp(-x @ w))
                slope += x.T @ (n * (y - p))
                hess += (x * (n * p * (1 - p))[:, None]).T @ x
            yield pa.RecordBatch.from_arrays([pa.array([np.append(slope, hess).tobytes()], pa.binary())], names=["sums"])

        return summed(table.mapInArrow(run, "sums binary"))

    w = np.zeros(4)
    for _ in range(25):  # Newton steps
        found = sums(w)
        step = np.linalg.solve(found[4:].reshape(4, 4) + np.diag(hold), found[:4] - hold * w)
        w = w + step
        if np.abs(step).max() < 1e-10:  # nothing moves any more
            break
    return w.tolist()


def scored(docs: DataFrame, logs, lexicon: dict[str, float], weights: list[float]) -> DataFrame:
    """doc_id and score of each document."""
    def run(batches):
        import pyarrow as pa

        reader = Reader(logs)
        for batch in slices(batches, "text"):
            scores = []
            for t in batch.column(1).to_pylist():
                z = weights[0] + sum(a * b for a, b in zip(weights[1:], _signals(reader.text(t or ""), lexicon)))
                scores.append(1 / (1 + math.exp(-max(-50.0, min(50.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op10_toxicity(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").select("doc_id", "toxic")
    logs = letter_logs(letter_counts(docs))
    lexicon, weights = fit(docs, labels, logs)
    return scored(docs, logs, lexicon, weights).select(
        "doc_id", (fold("doc_id", HELD_FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLE: dict[str, str] = {}
