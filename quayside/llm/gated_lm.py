"""Log-likelihood of whole texts under a gated recurrent language model.

Words of all training documents are counted with Spark. Those that make up at
least one in `SHARE` tokens are modelled: sorted by frequency, they fall into
classes of about equal mass, and the next word's probability is
p(class | state) p(word | class, state), two small softmaxes. All other words
form one more class, inside which a word has its smoothed share of the corpus,
so that every word has a probability.

The state is that of a gated recurrent unit; it starts anew with each document.
Weights start where the model equals the smoothed word frequencies, and are
trained by truncated backpropagation through time on every token of all training
documents: a task streams the documents it holds through consecutive updates,
documents side by side, and the tasks' weights are averaged by tokens, added up
by tasks before the driver sees them.

Scoring reads each text whole. Documents run side by side, longest first; the
state is carried to a text's end, so a text has no limit of length. Words among
the `HEAD` most frequent are counted up in the task; the rest meet their counts
in a join, a row per document and word. A hot word is always among the former,
as they are all words from some count on.

Defined results: a null text counts as empty; an empty text is its end alone;
repeated rows are scored each, and count each time in training; with no
training documents every token has the share of an unseen one; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import fold, read, saved, slices, summed
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

FOLDS, HELD = 5, 1
HEAD, SHARE, HIDDEN = 100_000, 200_000, 16
ROUNDS, WINDOW, SIDE_BY_SIDE, RATE, CLIP, LARGEST = 1, 16, 256, 0.2, 1.0, 4.0
TRAIN_CHARS = 8 << 20  # of text that a task lays out side by side at once
UPDATED, LAID_OUT = 4096, 1 << 15  # rows of weights, and numbers of a softmax over classes, worked on at once
COUNT_CHARS = 16 << 20  # of text whose words a task counts before it hands them on
SCORE_CHARS, SCORE_TOKENS = 16 << 20, 1 << 14  # of text run side by side; of states whose words are looked up at once
END = ""  # as a word: the end of a text


def split(texts):
    """The lower-cased (A to Z) words of an Arrow array of texts one after the other, and where those of each text end; null: none.

    Arrow's blanks of ASCII are those that part words.
    """
    import numpy as np
    import pyarrow.compute as pc

    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    some = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
    lists = pc.ascii_split_whitespace(texts.filter(some))
    sizes = np.zeros(len(texts), np.int64)
    sizes[some.to_numpy(zero_copy_only=False)] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.cumsum(sizes)


def places_of(words, table):
    """Where each word stands in `table`, both Arrow arrays; the table's length if nowhere."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.index_in(words, value_set=table.cast(words.type)), len(table)).to_numpy(zero_copy_only=False)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n over all `docs`, the end among the words."""
    def run(batches):
        import pyarrow as pa

        for batch in gathered(slices(batches, text), COUNT_CHARS):
            words, _ = split(batch.column(0))
            values, counts = words.value_counts().flatten()
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([values.cast(pa.string()), pa.array([END], pa.string())]),
                pa.concat_arrays([counts, pa.array([batch.num_rows], pa.int64())])], names=["word", "n"])

    return docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Corpus:
    """What scoring needs of the counts: totals and the most frequent words."""
    tokens: int
    distinct: int
    head: list[tuple[str, int]]  # words counted `head_from` times or more, and the end; most frequent first
    head_from: int
    modelled: list[str]  # by class, most frequent first
    bounds: list[int]  # where each class begins among them, and their end
    rest_tokens: int
    rest_distinct: int


def survey(counts: DataFrame) -> Corpus:
    totals = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("distinct")).first()
    # levels of eight to a doubling of the count: some hundreds of rows say from which count on words are few enough
    levels = counts.groupBy(F.floor(8 * F.log2("n")).alias("level")).agg(
        F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).collect()
    head_from, words = 1 << 62, 0
    for level in sorted(levels, key=lambda r: -r.level):
        words += level.words
        if words > HEAD:
            break
        head_from = level.n
    head = [(r.word, r.n) for r in counts.filter((F.col("n") >= head_from) | (F.col("word") == END)).collect()]  # HEAD at most, and the end
    head.sort(key=lambda r: (-r[1], r[0]))
    modelled = [w for w, n in head if n * SHARE >= (totals.tokens or 0)]
    if END not in modelled:
        modelled.append(END)
    n = dict(head)
    mass = [n.get(w, 0) + 0.5 for w in modelled]
    total, classes = sum(mass), max(1, math.isqrt(len(modelled)))
    bounds, upto = [0], 0.0
    for i, m in enumerate(mass):
        upto += m
        if upto >= total * len(bounds) / classes and i + 1 < len(modelled):
            bounds.append(i + 1)
    bounds.append(len(modelled))
    tokens, distinct = totals.tokens or 0, totals.distinct
    return Corpus(tokens, distinct, head, head_from, modelled, bounds, tokens - sum(n.get(w, 0) for w in modelled),
                  distinct - sum(w in n for w in modelled))


def start(corpus: Corpus) -> dict:
    """Weights of a model that equals the smoothed frequencies: no state says anything yet.

    `e` holds input vectors (the last is that of all other words), `x`, `u` and `b` are the unit's; `c` and `w` hold a row
    for each class and word, the last column of which is for a state's constant.
    """
    import numpy as np

    rng, n = np.random.default_rng(6), dict(corpus.head)
    words = len(corpus.modelled)
    small = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    mass = np.array([n.get(w, 0) + 0.5 for w in corpus.modelled])
    of_class = np.add.reduceat(mass, corpus.bounds[:-1])
    every = np.append(of_class, corpus.rest_tokens + 0.5 * (corpus.rest_distinct + 1))  # the last class is all other words
    constant = lambda logs: np.column_stack([np.zeros((len(logs), HIDDEN)), logs]).astype(np.float32)
    return {
        "e": small(0.3, words + 1, HIDDEN), "x": small(0.3, HIDDEN, 3 * HIDDEN), "u": small(0.1, HIDDEN, 3 * HIDDEN),
        "b": np.zeros(3 * HIDDEN, np.float32), "c": constant(np.log(every / every.sum())),
        "w": constant(np.log(mass / np.repeat(of_class, np.diff(corpus.bounds)))),
    }


def sorted_places(places, size: int):
    """The order that sorts places below or at `size`; those of 16 bits are sorted by digits, many times faster."""
    import numpy as np

    return np.argsort(places.astype(np.uint16) if size < 1 << 16 else places, kind="stable")


def outputs(p: dict, bounds, states, words, learn=None):
    """Log-probability of each row's word (the number of words stands for any other).

    With `learn`, also the gradient of the states; gradients of weights go to learn(name, rows of it, gradient).

    Rows are sorted by word, and so by class. The gradient of a softmax is its probabilities less one at the word that came.
    Products here are small and many: `dot` has less to do before it multiplies than `@`, and is fastest with words by columns.
    """
    import numpy as np

    bounds = np.asarray(bounds)
    n, size, kind = len(words), int(bounds[-1]), states.dtype
    order = sorted_places(words, size)
    words, rows = words[order], np.ones((n, HIDDEN + 1), kind)
    rows[:, :HIDDEN] = states.take(order, axis=0)
    edges = np.append(np.searchsorted(words, bounds), n)  # any other word is beyond the last bound: the last class
    known, came = int(edges[-2]), np.diff(edges)
    of_class = np.repeat(p["c"], came, axis=0)
    logs = np.einsum("ij,ij->i", rows, of_class).astype(np.float64)
    total, inside, logits = np.empty(n, kind), np.ones(known, kind), np.zeros(known, kind)
    ones, by_class, by_word = np.ones(size + 1, kind), np.ascontiguousarray(p["c"].T), p["w"].T
    # where each row's word is among the products of the rows and words of its class
    sizes = np.diff(bounds)
    among = (np.arange(known) - np.repeat(edges[:-2], came[:-1])) * np.repeat(sizes, came[:-1]) + words[:known] - np.repeat(bounds[:-1], came[:-1])
    if learn:
        back, back_inside, weights = np.empty((n, HIDDEN), kind), np.zeros((known, HIDDEN), kind), np.ascontiguousarray(p["c"][:, :HIDDEN])
        of_c, of_w = np.zeros(p["c"].shape, kind), np.zeros(by_word.shape, kind)
    for a in range(0, n, many := max(1, LAID_OUT // len(bounds))):
        some = rows[a:a + many]
        e = some.dot(by_class)
        np.exp(e, out=e)  # weights are held down, so nothing overflows
        sums = e.dot(ones[:len(bounds)])
        total[a:a + many] = sums
        if learn:
            np.dot(e, weights, out=back[a:a + many])
            of_c += e.T.dot(some / sums[:, None])
    spans = zip(edges.tolist(), edges[1:].tolist(), bounds.tolist(), bounds[1:].tolist())
    for a, b, lo, hi in (span for span in spans if span[0] < span[1] and span[3] - span[2] > 1):  # a class of one word says nothing inside
        some, here = rows[a:b], among[a:b]
        e = some.dot(by_word[:, lo:hi])
        flat = e.reshape(-1)
        logits[a:b] = flat[here]
        np.exp(e, out=e)
        sums = e.dot(ones[:hi - lo])
        inside[a:b] = sums
        if learn:
            flat[here] -= sums
            np.dot(e, by_word[:HIDDEN, lo:hi].T, out=back_inside[a:b])
            np.matmul((some / sums[:, None]).T, e, out=of_w[:, lo:hi])
    logs -= np.log(total)
    logs[:known] += logits
    logs[:known] -= np.log(inside)
    places = np.empty_like(order)
    places[order] = np.arange(n)
    if not learn:
        return logs.take(places), None
    back /= total[:, None]
    back -= of_class[:, :HIDDEN]
    back_inside /= inside[:, None]
    back[:known] += back_inside
    some = np.flatnonzero(came)
    of_c[some] -= np.add.reduceat(rows, edges[some], axis=0) if n else 0
    learn("c", slice(None), of_c)
    if known:
        learn("w", slice(None), of_w.T)
    return logs.take(places), back.take(places, axis=0)


def backpropagated(p: dict, bounds, fed, words, valid, h, end: int, learn):
    """One window for documents side by side (steps x documents): the last state, and the words' log-probabilities.

    `fed` are the words before `words`; an end starts the state anew. Gradients of the negated sum go to `learn`.

    Arrays are steps x units x documents, so that what a step works on lies together: its word's vector, a constant and the old
    state, which one product takes to the new state's sum, those in the gates z and r, and what r is to let through. A gate
    is (tanh(sum / 2) + 1) / 2: the products are halved before, and z and r are held doubled.
    """
    import numpy as np

    n, (steps, rows), kind = HIDDEN, fed.shape, p["x"].dtype
    goes_on = (fed != end).astype(kind)
    of_x = np.concatenate([p["x"][:, 2 * n:], p["x"][:, :2 * n]], axis=1).T
    to_sums = np.zeros((4 * n, 2 * n + 1), kind)
    to_sums[:3 * n, :n], to_sums[:3 * n, n] = of_x, np.concatenate([p["b"][2 * n:], p["b"][:2 * n]])
    to_sums[n:, n + 1:] = p["u"].T
    to_sums[n:] *= 0.5
    given, sums, states = (np.empty((steps, k, rows), kind) for k in (2 * n + 1, 4 * n, n))
    given[:, :n], given[:, n] = p["e"].take(fed, axis=0).transpose(0, 2, 1), 1
    h = h.T
    for t in range(steps):
        made = sums[t]
        old = np.multiply(h, goes_on[t], out=given[t, n + 1:])
        np.dot(to_sums, given[t], out=made)
        new, gates = made[:n], made[n:3 * n]
        np.tanh(gates, out=gates)
        gates += 1
        new += gates[n:] * made[3 * n:]
        np.tanh(new, out=new)
        h = np.subtract(new, old, out=states[t])
        h *= gates[:n]
        h *= 0.5
        h += old
    by_row, where = states.transpose(0, 2, 1).reshape(-1, n), slice(None) if valid.all() else valid.ravel()
    back = np.zeros((steps * rows, n), kind)
    logs, back[where] = outputs(p, bounds, by_row[where], words.ravel()[where], learn)
    back = np.ascontiguousarray(back.reshape(steps, rows, n).transpose(0, 2, 1))
    new, z, r, let = (sums[:, k * n:(k + 1) * n] for k in range(4))
    # what a state's gradient is multiplied by on its way to the four sums, and past the unit
    factors = np.empty((steps, 4, n, rows), kind)
    to_new, to_z, to_r, to_let = (factors[:, k] for k in range(4))
    past = 2 - z
    np.multiply(new, new, out=to_new)
    np.subtract(1, to_new, out=to_new)
    to_new *= z
    to_new *= 0.5
    np.subtract(new, given[:, n + 1:], out=to_z)
    to_z *= z
    to_z *= past
    to_z *= 0.25
    np.multiply(to_new, r, out=to_let)
    to_let *= 0.5
    np.subtract(2, r, out=to_r)
    to_r *= to_let
    to_r *= let
    past *= goes_on[:, None]
    past *= 0.5
    dh = np.zeros((n, rows), kind)
    for t in range(steps - 1, -1, -1):
        dh += back[t]
        of_sums = np.multiply(factors[t], dh, out=factors[t])
        to_old = p["u"].dot(of_sums[1:].reshape(3 * n, rows))
        to_old *= goes_on[t]
        dh *= past[t]
        dh += to_old
    of_sums = factors.reshape(steps, 4 * n, rows)
    total = np.matmul(of_sums, given.transpose(0, 2, 1)).sum(0)
    inputs = np.concatenate([total[n:3 * n], total[:n]])
    of_vectors = np.matmul(of_sums[:, :3 * n].transpose(0, 2, 1), of_x).reshape(-1, n)
    learn("x", slice(None), inputs[:, :n].T)
    learn("u", slice(None), total[n:, n + 1:].T)
    learn("b", slice(None), inputs[:, n])
    # only the vectors of words that came are touched
    numbers = np.zeros(len(p["e"]), np.int64)
    numbers[fed] = 1
    came = np.flatnonzero(numbers)
    numbers[came] = np.arange(len(came)) * n
    numbers = numbers.take(fed.ravel())[:, None] + np.arange(n)
    learn("e", came, np.bincount(numbers.ravel(), of_vectors.ravel()).reshape(-1, n).astype(kind))
    return states[-1].T, logs


class Trainer:
    """Weights on their way through consecutive updates."""

    def __init__(self, p: dict, bounds, end: int):
        import numpy as np

        self.p, self.bounds, self.end, self.tokens = {k: v.copy() for k, v in p.items()}, bounds, end, 0
        self.p["w"] = np.asfortranarray(p["w"])  # words by columns: see `outputs`
        self.squares = {k: np.full_like(v, 1e-2) for k, v in self.p.items()}

    def update(self, name: str, rows, gradient) -> None:
        """One step against a gradient, which is written over; some rows at a time, so that all of theirs stays in a core's cache."""
        import numpy as np

        whole = isinstance(rows, slice)
        weights, squares = (a[name] if whole else a[name].take(rows, axis=0) for a in (self.p, self.squares))
        for at in range(0, len(gradient), UPDATED):
            g, p, s = (part[at:at + UPDATED].T for part in (gradient, weights, squares))
            g *= 1 / self.side_by_side
            np.clip(g, -CLIP, CLIP, out=g)
            used = g * g
            s += used
            g *= RATE
            g /= np.sqrt(s, out=used)
            p -= g
            if name in "cw":
                np.clip(p[:HIDDEN], -LARGEST, LARGEST, out=p[:HIDDEN])  # but for the constant
        if not whole:
            self.p[name][rows], self.squares[name][rows] = weights, squares

    def read(self, stream) -> None:
        """Learn from documents, one after the other as word places, laid out in rows of equal length."""
        import numpy as np

        rows = max(1, min(SIDE_BY_SIDE, len(stream) // WINDOW))
        length = -(-len(stream) // rows)
        grid = np.full(rows * length, self.end, np.int32)
        grid[:len(stream)] = stream
        valid = (np.arange(rows * length) < len(stream)).reshape(rows, length).T
        fed = np.concatenate([[self.end], grid[:-1]]).reshape(rows, length).T
        grid, self.side_by_side = grid.reshape(rows, length).T, rows
        h = np.zeros((rows, HIDDEN), np.float32)
        for at in range(0, length, WINDOW):
            to = at + WINDOW
            h, _ = backpropagated(self.p, self.bounds, fed[at:to], grid[at:to], valid[at:to], h, self.end, self.update)
        self.tokens += len(stream)


def gathered(batches, chars: int):
    """Arrow batches put together until they hold `chars` bytes."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= chars:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def train(docs: DataFrame, corpus: Corpus, text: str = "text") -> dict:
    """Weights after `ROUNDS` over all training documents, averaged over tasks by tokens."""
    import numpy as np

    weights, bounds = start(corpus), corpus.bounds
    end, names = corpus.modelled.index(END), list(weights)
    for _ in range(ROUNDS):
        sent = docs.sparkSession.sparkContext.broadcast((weights, corpus.modelled))  # HEAD words at most

        def run(batches):
            import pyarrow as pa

            given, modelled = sent.value
            trainer, table = Trainer(given, bounds, end), pa.array(modelled, pa.string())
            for batch in gathered(slices(batches, text), TRAIN_CHARS):
                words, ends = split(batch.column(0))
                trainer.read(np.insert(places_of(words, table), ends, end))
            if trainer.tokens:
                total = np.append(np.concatenate([trainer.p[k].ravel() for k in names]).astype(np.float64), 1.0) * trainer.tokens
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        total = summed(docs.select(text).mapInArrow(run, "sums binary"))
        if total is None:
            break
        flat, at = total[:-1] / total[-1], 0
        for k in names:
            size = weights[k].size
            weights[k] = flat[at:at + size].reshape(weights[k].shape).astype(np.float32)
            at += size
    return weights


def likelihoods(p: dict, bounds, end: int, docs: list):
    """Natural log-probability of each document (an array of word places, end included), state carried to its end."""
    import numpy as np

    if not docs:
        return np.zeros(0)
    # planes of the gates z and r and the new state, words x units each; halved as in `backpropagated`
    x, u = (np.ascontiguousarray(a.reshape(-1, 3, HIDDEN).transpose(1, 0, 2)) for a in (p["e"] @ p["x"] + p["b"], p["u"]))
    x[:2] *= 0.5
    u *= 0.5
    p = {**p, "w": np.asfortranarray(p["w"])}
    order = np.argsort([-len(d) for d in docs], kind="stable")
    lengths = np.array([len(docs[i]) for i in order])
    flat, first = np.concatenate([docs[i] for i in order]), np.cumsum(lengths) - lengths
    h, sums, sums_of_step = np.zeros((len(docs), HIDDEN), x.dtype), np.zeros(len(docs)), np.empty((3, len(docs), HIDDEN), x.dtype)
    longer = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # documents longer than so many steps
    upto, at = np.cumsum(longer), 0
    while at < lengths[0]:
        # some steps, the words of which are looked up at once
        to = min(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SCORE_TOKENS)) + 1, int(lengths[0]))
        alive = longer[at:to]
        edges = np.append(0, np.cumsum(alive))
        doc = np.arange(edges[-1]) - np.repeat(edges[:-1], alive)
        places = first[doc] + np.repeat(np.arange(at, to), alive)
        fed = flat[places - 1]
        if not at:
            fed[:alive[0]] = end
        given, states = x.take(fed, axis=1), np.empty((len(fed), HIDDEN), x.dtype)
        edges = edges.tolist()
        for a, b in zip(edges, edges[1:]):
            h = h[:b - a]
            made = np.matmul(h, u, out=sums_of_step[:, :b - a])
            gates, new = made[:2], made[2]
            gates += given[:2, a:b]
            np.tanh(gates, out=gates)
            gates += 1
            new *= gates[1]
            new += given[2, a:b]
            np.tanh(new, out=new)
            new -= h
            new *= gates[0]
            new *= 0.5
            h = np.add(new, h, out=states[a:b])
        logs, _ = outputs(p, bounds, states, flat[places])
        sums[:alive[0]] += np.bincount(doc, logs)
        at = to
    scores = np.empty(len(docs))
    scores[order] = sums
    return scores


def scored(docs: DataFrame, counts: DataFrame, corpus: Corpus, weights: dict, text: str = "text") -> DataFrame:
    """`docs` without its text: n_tokens, n_known, base_score and score."""
    names = [c for c in docs.columns if c != text]
    kept = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names)
    bounds, other = corpus.bounds, corpus.bounds[-1]
    place = {w: i for i, w in enumerate(corpus.modelled)}
    known, end = {END: 0} | dict(corpus.head), place[END]
    # one table for all tasks of an executor: words; by number the place in the model and the count
    table = docs.sparkSession.sparkContext.broadcast((list(known), [place.get(w, other) for w in known], list(known.values())))
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        head, places, counts = table.value
        head, counts, ending = pa.array(head, pa.string()), np.array(counts), head.index(END)
        # the last number stands for words beyond the head
        places, by_count, seen = np.array([*places, other], np.int32), np.append(np.log10(counts + 0.5), 0.0), np.append(counts > 0, False)
        shared = np.append(places[:-1] == other, False)
        for batch in gathered(slices(batches, text), SCORE_CHARS):
            words, ends = split(batch.column(batch.schema.get_field_index(text)))
            found = places_of(words, head)
            beyond = np.flatnonzero(found == len(head))
            found, sizes = np.insert(found, ends, ending), np.diff(ends, prepend=0) + 1
            first, coded, by_word = np.cumsum(sizes) - sizes, places[found], by_count[found]
            sums = lambda values, kind: np.add.reduceat(values, first, dtype=kind)
            tail = pa.table({"doc": np.searchsorted(ends, beyond, side="right"), "word": words.take(pa.array(beyond)).cast(pa.string())}).group_by(
                ["doc", "word"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc").combine_chunks()
            upto = np.searchsorted(tail["doc"].to_numpy(), np.arange(len(ends) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(upto, pa.StructArray.from_arrays(
                [pa.concat_arrays(tail["word"].chunks or [pa.array([], pa.string())]),
                 pa.concat_arrays(tail["count_all"].chunks or [pa.array([], pa.int64())]).cast(pa.int32())], names=["word", "n"]))
            columns = [
                *[batch.column(batch.schema.get_field_index(c)) for c in names],
                pa.array(sizes), pa.array(sums(seen[found], np.int64)), pa.array(sums(by_word, np.float64)),
                pa.array(sums(by_word * shared[found], np.float64)), pa.array(sums(coded == other, np.int64)), lists]
            del words, found, beyond, by_word, tail  # as large as the text
            columns.append(pa.array(likelihoods(model.value, bounds, end, np.split(coded, first[1:]))))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_tokens", "n_known", "base", "by_share", "n_other", "tail", "logs"])

    out = (f"{kept}, n_tokens long, n_known long, base double, by_share double, n_other long, "
           "tail array<struct<word:string,n:int>>, logs double")
    rows = saved(docs.mapInArrow(run, out).withColumn("row", F.monotonically_increasing_id()), "language-model-scores")
    # the words beyond the head, one row per document and word
    tail = rows.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("times"))
    rest = counts.filter(F.col("n") < corpus.head_from)
    met = tail.join(rest, "word", "left").withColumn("c", F.coalesce("n", F.lit(0))).groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("tail_logs"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    per_token = math.log10(corpus.tokens + 0.5 * (corpus.distinct + 1))
    per_other = math.log10(corpus.rest_tokens + 0.5 * (corpus.rest_distinct + 1))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return rows.join(met, "row", "left").select(
        *names, "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        (F.col("base") + zero("tail_logs") - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("logs") / math.log(10) + F.col("by_share") + zero("tail_logs") - F.col("n_other") * per_other).alias("score"))


def op6_lm_scores(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", FOLDS) == HELD).alias("held_out"))
    own = docs.filter(~F.col("held_out"))
    counts = saved(word_counts(own), "word-counts")
    corpus = survey(counts)
    weights = train(own, corpus)
    return scored(docs, counts, corpus, weights).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(corpus.tokens).cast("long").alias("train_tokens"), "base_score", "score")


QUERIES = {"op6_lm_scores": op6_lm_scores}
ORACLE: dict[str, str] = {}
