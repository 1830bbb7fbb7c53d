"""Personal data in whole texts, and the terms that give it away.

Base: e-mail addresses, IP addresses, card numbers and telephone numbers by
pattern and check, leftmost first, each kind on its own. Every pattern is tried
only where a match can begin, so a text is read in time in proportion to its
length.

Information-theoretic sanitisation. Protected is each entity, what it belongs to
(an address's domain, a network, a card's issuer, a number's country and area)
and its kind; the last two recur in documents that are no copies. What is
protected has the information IC(e) = -log2 p(e), and a term discloses of it
PMI(e; t) = log2 p(e | t) / p(e). All shares are of whole documents: those with
e, with the term, and with both. No pair is left out for being rare; p(e | t) is
smoothed instead. Its prior is p(e), and the share seen counts by the odds that
the pair is no chance meeting: one term of all is taken to be tied to each e
beforehand, and the evidence is the least Bayes factor -e P ln P, where chance
brings as many meetings with P = 2 ** -(n_term KL(p(e | t) || p(e))) at most.

`LEVELS` names, for entities, what they belong to, and kinds, which share of
the information a term may disclose. A term beyond the first share is a span of
its own wherever it stands in the corpus, and is generalised to its shape in the
sanitised text (a name, an abbreviation, a code or a word); beyond the second it
is removed. Base spans become the name of their kind.

One pass finds base spans, and the terms of documents that hold any: only these
can meet something protected. What is in too few documents to disclose enough
even if a term stood nowhere else is left out by the same formula. One pass
counts the terms that are left, over all documents, and one marks those that
disclose. Both know them by a bitmap of their hashes, of a fixed size; a join on
the term decides. The number of all terms is estimated from one in `PICKED` of
them, picked by hash. Findings are kept by id and a hash of id and text, so texts
are not shuffled to count.

Defined results: a null text counts as empty; rows that repeat id and text
each count as a document and get equal spans; what is in every document has
nothing to disclose; a term that overlaps a base span is part of it; an empty
table gives an empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayside.llm.common import key_of, read, saved, slices
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

KINDS = ("email", "ip", "card", "phone", "term")
# of entities, of what they belong to, of kinds: from which share on a term is generalised, and removed
LEVELS = ((0.8, 0.95), (0.8, 0.95), (0.9, 0.98))
TABLE = 200_000  # terms a task counts before it hands them on
BITMAP = 1 << 26  # bits
PICKED = 32  # one term in so many is counted whatever it is

# The patterns of the four kinds.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _passes(kind: str, found: str) -> bool:
    if kind == "ip":  # leading zeros do not make a part larger
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def protected(kind: str, found: str) -> list[tuple[int, str]]:
    """(level, name) of an entity, of what it belongs to, and of its kind."""
    found = found.lower()
    digits = "".join(c for c in found if "0" <= c <= "9")
    belongs = {"email": lambda: found.split("@")[1], "ip": lambda: ".".join(found.split(".")[:3]), "card": lambda: digits[:6],
               "phone": lambda: digits[:4]}[kind]()
    return [(0, f"{kind}:{found if kind == 'email' else digits if kind != 'ip' else found}"), (1, f"{kind}:{belongs}"), (2, kind)]


class Finder:
    def __init__(self):
        self.patterns = {k: re.compile(p) for k, p in PATTERNS.items()}
        # inside a run of digits no address can begin that does not begin at its front
        self.ip = re.compile(rf"(?<![0-9]){PATTERNS['ip']}")
        self.token = re.compile(r"\S+")

    def base(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end), by kind, then start."""
        found = []
        for kind in PATTERNS:
            if kind == "email":
                matches = self._emails(text) if "@" in text else ()
            elif kind == "phone":
                matches = self.patterns[kind].finditer(text) if "+" in text else ()
            else:
                matches = (self.ip if kind == "ip" else self.patterns[kind]).finditer(text)
            found += [(kind, m.start(), m.end()) for m in matches if _passes(kind, m[0])]
        return found

    def _emails(self, text: str):
        """Matches of the e-mail pattern, tried only in front of each "@"."""
        at, done = text.find("@"), 0
        while at >= 0:
            start = at
            while start > done and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "._%+-"):
                start -= 1
            m = self.patterns["email"].match(text, start) if start < at else None
            if m:
                yield m
                done = m.end()
            at = text.find("@", max(at + 1, done))

    @staticmethod
    def term(token: str) -> str:
        """A token without the marks around it, "" if it has no letter."""
        if token.isalpha():
            return token
        start, end = 0, len(token)
        while start < end and not token[start].isalnum():
            start += 1
        while end > start and not token[end - 1].isalnum():
            end -= 1
        core = token[start:end]
        return core if any(map(str.isalpha, core)) else ""

    def places(self, text: str, base: list[tuple[str, int, int]], of) -> list[tuple[str, int, int]]:
        """(term, start, end) of the terms that overlap no base span; of(token) is a token's term in lower case, or "" to leave it out."""
        import bisect

        found, taken = [], []
        for s, e in sorted((s, e) for _, s, e in base):  # kinds may overlap: their union is taken
            if taken and s < taken[-1][1]:
                taken[-1] = taken[-1][0], max(taken[-1][1], e)
            else:
                taken.append((s, e))
        for m in self.token.finditer(text):
            term = of(m[0])
            if not term:
                continue
            i = bisect.bisect_left(taken, (m.end(), 0))
            if not i or taken[i - 1][1] <= m.start():
                core = self.term(m[0])
                start = m.start() + m[0].index(core)
                found.append((term, start, start + len(core)))
        return found


def term_of(token: str) -> str:
    return Finder.term(token).lower()


class Terms(dict):
    """token -> its lower-case term if a bitmap has it (or a hash picks it), else "". Remembers the tokens it has seen, up to a limit."""

    def __init__(self, bits, picked: bool):
        self.bits, self.picked = bits, picked

    def __missing__(self, token: str) -> str:
        if len(self) >= TABLE:
            self.clear()
        term = term_of(token)
        self[token] = found = term if term and self.holds(term) else ""
        return found

    def holds(self, term: str) -> bool:
        import zlib

        raw = term.encode("utf-8", "surrogatepass")
        first = zlib.crc32(raw) % BITMAP
        if self.bits[first >> 3] >> (first & 7) & 1:
            second = zlib.crc32(raw, _OTHER) % BITMAP
            if self.bits[second >> 3] >> (second & 7) & 1:
                return True
        return self.picked and first % PICKED == 0


_OTHER = 0xA505DF1B  # crc32 of a byte 1: the second hash is that of the term behind such a byte


def bitmap(terms: DataFrame):
    """A bit for each of two hashes of `term`, sent to all executors."""
    import numpy as np

    hashes = F.array(F.crc32(F.col("term").cast("binary")), F.crc32(F.concat(F.lit("\x01"), "term").cast("binary")))
    rows = terms.select(F.explode(hashes).alias("h")).select((F.col("h") % BITMAP).alias("bit")).groupBy(
        F.floor(F.col("bit") / 64).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    hits = rows.toPandas()  # BITMAP / 64 rows at most
    bits = np.zeros(BITMAP // 64, np.int64)
    bits[hits["at"].to_numpy(int)] = hits["bits"].to_numpy(np.int64)
    return terms.sparkSession.sparkContext.broadcast(bits.tobytes())


_NOTED = ("doc_id {}, key long, base array<struct<kind:int,start:int,end:int>>, "
          "protected array<struct<level:int,name:string>>, terms array<string>")


def noted(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, key, text): base spans; if there are any, what is protected, and the terms outside of them."""
    def run(batches):
        import pyarrow as pa

        finder = Finder()
        kinds = (pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])),
                 pa.list_(pa.struct([("level", pa.int32()), ("name", pa.string())])), pa.list_(pa.string()))
        for batch in slices(batches, "text"):
            found = []
            for t in batch.column(2).to_pylist():
                base = finder.base(t or "")
                names = sorted({p for k, s, e in base for p in protected(k, t[s:e])})
                terms = sorted({term for term, _, _ in finder.places(t, base, term_of)}) if base else []
                found.append(([{"kind": KINDS.index(k), "start": s, "end": e} for k, s, e in base],
                              [{"level": level, "name": name} for level, name in names], terms))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]],
                                             names=["doc_id", "key", "base", "protected", "terms"])

    return docs.mapInArrow(run, _NOTED.format(docs.schema["doc_id"].dataType.simpleString()))


def term_counts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """term, n_term: how many `docs` (text) hold it, of all `candidates` (term), terms that share a bit with one, and some of all others, picked by hash."""
    sent = bitmap(candidates)

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        of, counts = Terms(sent.value, True), Counter()

        def handed():
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])
            counts.clear()
            return batch

        for batch in slices(batches, "text"):
            for t in batch.column(0).to_pylist():
                terms = set(map(of.__getitem__, set((t or "").split())))
                terms.discard("")
                counts.update(terms)
            if len(counts) > TABLE:
                yield handed()
        yield handed()

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosed(n_both: Column, n_term: Column, n_named: Column, docs: float, terms: float) -> Column:
    """The share of the information of something in n_named documents that a term in n_term documents discloses, met in n_both."""
    p = n_named / docs
    part = lambda x, of: F.when(x > 0, x * F.log2(x / of)).otherwise(0.0)
    seen = n_both / n_term
    kl = F.when(seen > p, part(seen, p) + part(1 - seen, 1 - p)).otherwise(0.0)
    chance = F.pow(F.lit(2.0), -n_term * kl)
    # an underflow to 0 is no chance at all
    by_chance = F.lit(terms) * F.when(chance <= 0, 0.0).when(chance < 1 / math.e, -math.e * chance * F.log(chance)).otherwise(1.0)
    return F.when(p < 1, F.log2((seen + by_chance * p) / (1 + by_chance) / p) / -F.log2(p)).otherwise(0.0)


def _level(place: int) -> Column:
    return F.element_at(F.array(*[F.lit(level[place]) for level in LEVELS]), F.col("level") + 1)


def disclosing(found: DataFrame, docs: DataFrame) -> DataFrame:
    """`found` (row, protected, terms) and `docs` (text) -> term, removed: the terms that disclose too much of anything protected, and whether they must go altogether."""
    total = float(found.count())
    held = found.filter(F.size("protected") > 0).select("row", "protected", "terms")
    met_terms = float(held.select(F.explode("terms").alias("term")).distinct().count())
    names = held.select(F.explode("protected").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n_named")).select(
        "p", "n_named", "p.level")
    n = lambda c: F.col(c).cast("double")
    # a term discloses most if it stands in all documents of the name and nowhere else
    able = names.filter(disclosed(n("n_named"), n("n_named"), n("n_named"), total, met_terms) >= _level(0))
    # a frequent name meets rows by their number, not by their terms
    # Spark sizes exploded rows and lists read from Parquet too low to broadcast them: only `able` may be
    name = F.when(F.col("n_named").isNotNull(), F.struct("p", "n_named", "level"))
    named = held.select("row", F.explode("protected").alias("p")).join(able, "p", "left").groupBy("row").agg(
        F.collect_list(name).alias("names")).filter(F.size("names") > 0)
    met = held.join(named.hint("merge"), "row").select(F.explode("names").alias("name"), "terms").select("name.*", F.explode("terms").alias("term")).groupBy(
        "p", "level", "n_named", "term").agg(F.count(F.lit(1)).alias("n_both"))
    # and for what it was met with if it stands nowhere else
    pairs = saved(met.filter(disclosed(n("n_both"), n("n_both"), n("n_named"), total, met_terms) >= _level(0)), "disclosing-pairs")
    counted = saved(term_counts(docs, pairs.select("term")), "term-counts")
    picked = counted.filter(F.crc32(F.col("term").cast("binary")) % PICKED == 0).count()
    share = disclosed(n("n_both"), n("n_term"), n("n_named"), total, max(float(PICKED * picked), met_terms))
    return saved(pairs.join(counted.hint("merge"), "term").withColumn("share", share).filter(F.col("share") >= _level(0)).groupBy("term").agg(
        F.max(F.col("share") >= _level(1)).alias("removed")), "disclosing")


def term_spans(docs: DataFrame, giving: DataFrame) -> DataFrame:
    """doc_id, key, marks: the spans (start, end, removed) of disclosing terms in all `docs` (doc_id, key, text) that have any."""
    sent, id = bitmap(giving), docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        finder, of = Finder(), Terms(sent.value, False)
        for batch in slices(batches, "text"):
            rows, terms, starts, ends = [], [], [], []
            for row, t in enumerate(batch.column(2).to_pylist()):
                if t and any(map(of.__getitem__, set(t.split()))):
                    for term, start, end in finder.places(t, finder.base(t), of.__getitem__):
                        rows.append(row)
                        terms.append(term)
                        starts.append(start)
                        ends.append(end)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(terms, pa.string()),
                                              pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["doc_id", "key", "term", "start", "end"])

    at = docs.mapInArrow(run, f"doc_id {id}, key long, term string, start int, end int")
    # rows that repeat id and text have one key
    spans = at.join(giving, "term").select("doc_id", "key", "start", "end", "removed").distinct()
    return spans.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("marks"))


def spans_of(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, key, base and terms."""
    keyed = docs.select(F.col(id).alias("doc_id"), key_of(id, text).alias("key"), F.col(text).cast("string").alias("text"))
    found = saved(noted(keyed).withColumn("row", F.monotonically_increasing_id()), "personal-data")
    marks = term_spans(keyed, disclosing(found, keyed.select("text"))).select(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), F.col("marks").alias("terms"))
    return found.select("doc_id", "key", "base").join(
        marks, (F.col("key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left").drop("of_id", "of_key")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op7_pii(spark, sf_dir):
    found = spans_of(read(spark, sf_dir, "documents"))
    added = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,removed:boolean>>")), lambda t: F.struct(
        F.lit(KINDS.index("term")).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(of, KINDS[:4]), F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _written(F.concat("base", added)).alias("spans"))


def sanitised(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with base spans replaced by their kind, and disclosing terms by their shape or by nothing."""
    # what is found is written once: where it is little, it is sent to the documents and not they to it
    found = saved(spans_of(docs, id, text).filter("size(base) > 0 or terms is not null").dropDuplicates(["doc_id", "key"]), "personal-spans")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id).alias("id"), key_of(id, text).alias("of_key"))
    joined = rows.join(found, (F.col("of_key") == F.col("key")) & F.col("id").eqNullSafe(F.col("doc_id")), "left").select("row", "base", "terms")
    place = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            row, bases, terms = batch.columns
            columns = row.flatten()
            hit = [i for i, base in enumerate(bases.is_valid()) if base.as_py() and columns[place][i].is_valid]
            if hit:
                texts = columns[place].to_pylist()
                for i in hit:
                    texts[i] = _replaced(texts[i], bases[i].as_py(), terms[i].as_py() or [])
                columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    out = docs.schema
    return joined.mapInArrow(run, out)


def shape(term: str) -> str:
    """What kind of word a term is: broader than the term, and shared by many."""
    if any(c.isdigit() for c in term):
        return "<CODE>"
    if len(term) > 1 and term.isupper():
        return "<ABBREVIATION>"
    return "<NAME>" if term[:1].isupper() else "<WORD>"


def _replaced(text: str, base: list[dict], terms: list[dict]) -> str:
    parts, at = [], 0
    marks = [(s["start"], -s["end"], f"<{KINDS[s['kind']].upper()}>") for s in base]
    marks += [(s["start"], -s["end"], "" if s["removed"] else shape(text[s["start"]:s["end"]])) for s in terms]
    for start, end, mark in sorted(marks):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, -end)  # kinds may overlap: their union goes
    return "".join([*parts, text[at:]])


def without_personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data and what gives it away taken out of the texts, and n_chars counted anew."""
    clean = sanitised(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


QUERIES = {"op7_pii": op7_pii}
ORACLE: dict[str, str] = {}
