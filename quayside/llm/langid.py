"""Language of documents by Bayesian fusion of text, declared language, address suffix and host.

Text: byte trigrams (lower case, hashed) under one multinomial model per
declared language, and a uniform one for text in none of them ("und").
Neighbouring trigrams overlap, so their evidence is tempered. The other evidence
is learned from the text evidence of all documents by grouped aggregation of
posteriors: how often each language is declared as what, how often it stands
under an address suffix, and how languages spread over hosts, each host smoothed
towards its domain and each domain towards the whole. A document's own
posterior is taken out of its host's and its domain's counts. A declared
language is cut to its primary tag; one that no model knows counts as other.
`from_markup` reads declaration and visible text out of HTML.

Models are fitted on a sample of documents per declared language, chosen by
hash of the id, of `FIT_DOCS` in the mean; everything else covers all rows.
Every language declared by `MIN_DOCS` documents or more has a model. A document
that declares a language without a model, and whose text is in none of the
others for sure, is taken at its word.

Defined results: a null text counts as empty; a text without a letter has no
language and is rejected; a missing declaration, address or suffix is no
evidence; repeated rows get equal results; with no declared language of
`MIN_DOCS` documents only declarations remain; an empty table gives an empty
result; other columns pass through whatever their names, and columns named like
the results give way.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayside.llm.common import appended, bound, read, saved, slices, with_arrays
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

BUCKETS = 1 << 15
FIT_DOCS, MIN_DOCS = 2000, 5
TEMPER = 0.3  # of the evidence of overlapping trigrams
SMOOTH = 0.5
KAPPA = 20.0  # documents a domain weighs against a host, and the whole against a domain
NONE_PRIOR = 0.001  # of text in no known language
MIN_CONFIDENCE = 0.5
PIECE = 1 << 16  # bytes of a text looked at together


def bucket_counts(text: str):
    """Buckets of the byte trigrams of a lower-cased text, and how often each occurs."""
    import numpy as np

    raw = text.lower().encode("utf-8", "surrogatepass")
    counts = None
    for start in range(0, max(0, len(raw) - 2), PIECE):
        b = np.frombuffer(raw[start:start + PIECE + 2], np.uint8).astype(np.int32)
        at = (b[:-2] * 7919 + b[1:-1] * 263 + b[2:]) & (BUCKETS - 1)
        if counts is None and len(raw) <= PIECE:
            return np.unique(at, return_counts=True)
        counts = np.bincount(at, minlength=BUCKETS) + (0 if counts is None else counts)
    if counts is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class Model:
    """Sparse: a language's log-probability of a bucket is its floor, and more where its sample has the bucket."""
    languages: list[str]
    floors: object  # log-probability of an unseen bucket, per language
    starts: object  # where a bucket's entries begin, and their end
    language: object  # of each entry
    more: object  # log-probability above the floor, of each entry

    def evidence(self, text: str):
        """Log-likelihood per language, none of them last."""
        import numpy as np

        buckets, counts = bucket_counts(text)
        first, many = self.starts[buckets], self.starts[buckets + 1] - self.starts[buckets]
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        own = np.bincount(self.language[at], weights=self.more[at] * np.repeat(counts, many), minlength=len(self.languages))
        total = counts.sum()
        return np.append(own + self.floors * total, -math.log(BUCKETS) * total)


def model_of(languages: list[str], language, bucket, n) -> Model:
    """Arrays of language places, buckets and counts, one entry for each pair."""
    import numpy as np

    totals = np.bincount(language, weights=n, minlength=len(languages)) + SMOOTH * BUCKETS
    order = np.argsort(bucket, kind="stable")
    return Model(languages, np.log(SMOOTH) - np.log(totals), np.searchsorted(bucket[order], np.arange(BUCKETS + 1)),
                 language[order], np.log((n[order] + SMOOTH) / SMOOTH).astype(np.float32))


def fit(docs: DataFrame, text: str = "text", declared: str = "lang", id: str = "doc_id", fit_docs: int = FIT_DOCS) -> Model:
    """Trigram models of the declared languages, from about `fit_docs` documents of each."""
    import numpy as np

    rows = docs.select(F.col(id).alias("id"), primary(declared).alias("tag"), F.col(text).alias("text")).filter(
        "tag is not null")
    # tags have two or three letters, so there are 18,252 at most
    tags = rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS)
    drawn = rows.join(F.broadcast(tags), "tag").filter(
        F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) * F.col("n") < F.lit(fit_docs << 30))

    def count(batches):
        sums: dict[str, object] = {}
        for batch in batches:
            for tag, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, n = bucket_counts(t or "")
                sums.setdefault(tag, np.zeros(BUCKETS, np.int64))[at] += n
                if len(sums) > 64:  # tags come in any order: a task holds some at a time
                    yield from handed(sums)
        yield from handed(sums)

    def handed(sums):
        import pyarrow as pa

        for tag, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([tag] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["tag", "bucket", "n"])
        sums.clear()

    counts = drawn.select("tag", "text").mapInArrow(count, "tag string, bucket long, n long").groupBy(
        "tag", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most, and no more than the samples hold
    languages = sorted(set(counts["tag"]))
    place = {t: i for i, t in enumerate(languages)}
    return model_of(languages, counts["tag"].map(place).to_numpy(np.int64), counts["bucket"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))


def primary(column: str | Column) -> Column:
    """The primary tag of a declared language; null if there is none."""
    of = F.col(column) if isinstance(column, str) else column
    return F.nullif(F.lower(F.regexp_extract(F.trim(of.cast("string")), "^([A-Za-z]{2,3})(?![A-Za-z])", 1)), F.lit(""))


# markup

# Elements whose content is not shown.
HIDDEN = ("script", "style", "noscript", "template", "head")


def shown(html: str) -> tuple[str | None, str]:
    """The language an HTML page declares, and its visible text. Each character is looked at once."""
    from html import unescape

    found = re.search(r"<html\b[^>]*", html[:1 << 16], re.I)
    lang = found and re.search(r"""\blang\s*=\s*["']?\s*([A-Za-z-]+)""", found[0], re.I)
    lower, parts, at = html.lower(), [], 0
    if len(lower) != len(html):  # a letter whose lower case has another length: places would move
        lower = re.sub("[A-Z]+", lambda m: m[0].lower(), html)
    while True:
        tag = html.find("<", at)
        parts.append(html[at:] if tag < 0 else html[at:tag])
        if tag < 0:
            break
        comment = lower.startswith("<!--", tag)
        end = lower.find("-->", tag) if comment else lower.find(">", tag)
        if end < 0:
            break
        name = "" if comment else re.match(r"[a-z0-9]*", lower[tag + 1:tag + 12])[0]
        if name in HIDDEN:
            end = lower.find(f"</{name}", end)
            end = lower.find(">", end) if end >= 0 else -1
            if end < 0:
                break
        at = end + (3 if comment else 1)
        parts.append(" ")
    return lang and lang[1], unescape("".join(parts))


def from_markup(pages: DataFrame, html: str = "html", declared: str = "declared", text: str = "text") -> DataFrame:
    """`pages` without `html`, but with the language it declares and its visible text."""
    kept = T.StructType([f for f in pages.schema.fields if f.name != html])
    out = appended(kept, T.StructField(declared, T.StringType()), T.StructField(text, T.StringType()))

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, html):
            found = [shown(t) if t else (None, "") for t in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            yield with_arrays(batch, out.names, {declared: pa.array([d for d, _ in found], pa.string()), text: pa.array([t for _, t in found], pa.string())})

    return pages.mapInArrow(run, out)


# evidence

def _host(address: Column) -> Column:
    """Host of an address or a bare host name, without "www."; null if there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(address)), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?(?:www\.)?([^/:?#]*)", 1), F.lit(""))


def _softmax(logs: Column) -> Column:
    """Probabilities of an array of logs."""
    return bound(logs, lambda x: bound(F.transform(x, lambda v: F.exp(v - F.array_max(x))), lambda e: F.transform(
        e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))))


def _amount(n: Column | str) -> Column:
    return F.aggregate(n, F.lit(0.0), lambda a, b: a + b)


def laid_out(docs: DataFrame, declared: str, address: str | None, text: str, keep: list[str]) -> DataFrame:
    """row (the columns `keep`), tag, host, and body unless the text is in `row`."""
    host = _host(F.col(address).cast("string")) if address else F.lit(None).cast("string")
    columns = [F.struct(*[F.col(c) for c in keep]).alias("row"), primary(declared).alias("tag"), F.coalesce(host, F.lit("")).alias("host")]
    return docs.select(*columns, *([] if text in keep else [F.col(text).cast("string").alias("body")]))


def text_evidence(rows: DataFrame, model: Model, text: str, with_row: bool = True) -> DataFrame:
    """row, tag, host, and logs: the tempered log-likelihood of each text per language, none of them last; null without a letter."""
    inside = "body" not in rows.columns
    fields = [f for f in rows.schema.fields if f.name != "body" and (with_row or f.name != "row")]
    out = T.StructType([*fields, T.StructField("logs", T.ArrayType(T.DoubleType()))])

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            at = batch.schema.get_field_index("row" if inside else "body")
            texts = pc.struct_field(batch.column(at), text) if inside else batch.column(at)
            found = []
            for value in texts:
                t = value.as_py()
                found.append(TEMPER * model.evidence(t) if t and any(map(str.isalpha, t)) else None)
            yield with_arrays(batch, out.names, {"logs": pa.array(found, pa.list_(pa.float64()))})
            del texts, batch
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, out)


@dataclass
class Evidence:
    hosts: DataFrame  # host, n and domain_n (per language), alone (the host is its own domain), suffix (log of likelihood ratios)
    declared: DataFrame  # tag, says (log of likelihoods per language)
    other: list[float]  # of a tag that no model knows
    overall: list[float]


def gather(scored: DataFrame, model: Model) -> Evidence:
    """What all documents say of hosts, suffixes and declarations, from their text's posterior."""
    spark, size = scored.sparkSession, len(model.languages) + 1
    known = F.when(F.array_contains(F.array(*map(F.lit, model.languages)).cast("array<string>"), F.col("tag")), F.col("tag")).when(
        F.col("tag").isNotNull(), F.lit("other"))
    # a row per host, tag and language that has a share at all
    soft = scored.filter("logs is not null").select("host", known.alias("tag"), F.posexplode(_softmax(F.col("logs"))).alias("at", "p"))
    cells = saved(soft.filter("p > 0").groupBy("host", "tag", "at").agg(F.sum("p").alias("p")), "language-cells")
    total = [0.0] * size
    for r in cells.groupBy("at").agg(F.sum("p").alias("p")).collect():
        total[r["at"]] = r.p
    overall = [(v + 1) / (sum(total) + size) for v in total]
    overall[-1] = NONE_PRIOR
    overall = [v / sum(overall) for v in overall]

    def likelihoods(n: dict) -> list[float]:
        """log of p(value | language), smoothed towards p(value)."""
        mean = (sum(n.values()) + 1) / (sum(total) + size)
        return [math.log((n.get(i, 0.0) + KAPPA * mean) / (total[i] + KAPPA)) for i in range(size)]

    tags: dict[str, dict] = {}
    for r in cells.filter("tag is not null").groupBy("tag", "at").agg(F.sum("p").alias("p")).collect():  # languages squared at most
        tags.setdefault(r.tag, {})[r["at"]] = r.p
    says = spark.createDataFrame([(t, likelihoods(n)) for t, n in tags.items() if t != "other"], "tag string, says array<double>")

    def dense(df: DataFrame, key: str, name: str) -> DataFrame:
        """An array of `p` per language, for each `key`."""
        summed = df.groupBy(key, "at").agg(F.sum("p").alias("p")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("at", "p"))).alias("m"))
        return summed.select(key, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias(name))

    labels = F.split("host", "\\.")
    placed = cells.withColumn("domain", F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host"))).withColumn(
        "suffix", F.when(F.size(labels) > 1, F.element_at(labels, -1)))
    names = placed.select("host", "domain", "suffix").distinct()
    totals = F.array(*map(F.lit, total))
    under = F.zip_with("suffix_n", totals, lambda n, t: F.log((n + KAPPA * (_amount("suffix_n") + 1) / (sum(total) + 1)) / (t + KAPPA)))
    table = names.join(dense(placed, "host", "n"), "host").join(dense(placed, "domain", "domain_n"), "domain").join(
        dense(placed.filter("suffix is not null"), "suffix", "suffix_n"), "suffix", "left").select(
        F.col("host").alias("of_host"), "n", "domain_n", (F.col("host") == F.col("domain")).alias("alone"),
        F.coalesce(under, F.array_repeat(F.lit(0.0), size)).alias("suffix"))
    return Evidence(saved(table, "language-evidence"), says, likelihoods(tags.get("other", {})), overall)


def fused(scored: DataFrame, model: Model, evidence: Evidence) -> DataFrame:
    """`scored` with language, confidence, text_language and accepted."""
    size = len(model.languages) + 1
    zero, prior = F.array_repeat(F.lit(0.0), size), F.array(*map(F.lit, evidence.overall))
    rows = scored.join(evidence.hosts, F.col("host") == F.col("of_host"), "left").join(
        F.broadcast(evidence.declared.withColumnRenamed("tag", "of_tag")), F.col("tag") == F.col("of_tag"), "left")  # a row per language
    says = F.coalesce("says", F.when(F.col("tag").isNotNull(), F.array(*map(F.lit, evidence.other))), zero)
    without = lambda n, p: F.zip_with(n, p, lambda x, q: F.greatest(x - q, F.lit(0.0)))
    towards = lambda n, above: F.zip_with(n, above, lambda x, a: (x + KAPPA * a) / (_amount(n) + KAPPA))
    spread = bound(_softmax(F.col("logs")), lambda p: bound(towards(without("domain_n", p), prior), lambda d: F.when(
        F.col("alone"), d).otherwise(bound(without("n", p), lambda n: towards(n, d)))))
    host = F.when((F.col("host") == "") | F.col("n").isNull(), prior).otherwise(spread)
    parts = F.arrays_zip(F.col("logs").alias("t"), F.transform(host, lambda x: F.log(x)).alias("h"), says.alias("d"), F.coalesce("suffix", zero).alias("s"))
    names = F.array(*map(F.lit, [*model.languages, "und"]))
    best = lambda p: F.get(names, F.array_position(p, F.array_max(p)).cast("int") - 1)
    judged = rows.withColumn("p", _softmax(F.transform(parts, lambda x: x["t"] + x["h"] + x["d"] + x["s"])))
    sure = F.array_max("p") >= MIN_CONFIDENCE
    own_word = ((best(F.col("p")) == "und") | ~sure) & F.col("tag").isNotNull() & F.col("says").isNull()
    judged = judged.select("row", F.when(own_word, F.col("tag")).otherwise(best(F.col("p"))).alias("language"),
                           F.array_max("p").alias("confidence"), best(F.col("logs")).alias("text_language"), (sure | own_word).alias("sure"))
    return judged.withColumn("accepted", F.coalesce((F.col("language") != "und") & F.col("sure"), F.lit(False))).drop("sure")


RESULTS = ("language", "confidence", "text_language", "accepted")


def judged(docs: DataFrame, declared: str, address: str | None, text: str, id: str, keep: list[str]) -> DataFrame:
    """row (the columns `keep`), language, confidence, text_language and accepted.

    Texts are read once to learn from all, and once more to judge each if they
    are kept. Rows stay where they are as long as the table of hosts is small
    enough to broadcast; beyond that they are shuffled by host.
    """
    model = fit(docs, text, declared, id)
    rows = laid_out(docs, declared, address, text, keep)
    scored = saved(text_evidence(rows, model, text, with_row=text not in keep), "language-scores")
    return fused(text_evidence(rows, model, text) if text in keep else scored, model, gather(scored, model))


def identified(docs: DataFrame, declared: str = "lang", address: str | None = "source", text: str = "text",
               id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with language, confidence, text_language and accepted."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    return judged(docs, declared, address, text, id, kept).select("row.*", *RESULTS)


def op1_language_id(spark, sf_dir):
    return identified(read(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "language", F.round("confidence", 6).alias("confidence"), "text_language", "accepted")


def language_of_pages(spark, sf_dir):
    """The same operator over the table that has markup and addresses."""
    pages = saved(from_markup(read(spark, sf_dir, "pages").select("page_id", "url", "html")), "page-texts")
    return identified(pages, declared="declared", address="url", id="page_id", keep=["page_id"]).select(
        "page_id", "language", F.round("confidence", 6).alias("confidence"), "text_language", "accepted")


def known_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in a known language, which `lang` then names."""
    found = judged(docs, "lang", "source", "text", "doc_id", docs.columns).filter("accepted")
    return found.select(*[F.col("language").alias("lang") if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


QUERIES = {"op1_language_id": op1_language_id, "language_of_pages": language_of_pages}
ORACLE: dict[str, str] = {}
