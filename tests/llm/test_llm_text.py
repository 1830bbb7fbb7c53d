"""Language, sub-word pieces, near copies and personal data against brute force, and odd inputs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quayside.llm import components, disclosure, langid, pieces, simhash

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lo ng " * 30_000


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def exploded_in_broadcasts(df):
    """Nodes of the plan that multiply rows below a broadcast, with no shuffle between behind which Spark measures them."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = re.search(r"[A-Za-z]", line).start()
        above = [a for a in above if a[0] < depth]
        name = re.sub(r"^\W*(\(\d+\) )?", "", line)
        if name.startswith(("BroadcastExchange", "Exchange")):
            above.append((depth, name))
        elif name.startswith("Generate") and above and above[-1][1].startswith("Broadcast"):
            found.append(name)
    return found


# sub-word pieces

@pytest.fixture(scope="module")
def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces._model())


def test_pieces_equal_the_library(rows, processor):
    rnd = random.Random(3)
    texts = [None, "", " ", "\n", "▁", " a", "a ", "a  b", "\n a", "a" * 5000, LONG] + [
        "".join(rnd.choice(" ▁\n\t\rab.,<0x0A>;é中　ﬁ😀\x00") for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    df = rows("doc_id long, text string, ids string", *[(i, t, "clash") for i, t in enumerate(texts)], (0, None, "again"))
    out = pieces.decode(pieces.encode(df, pieces._model(), table_limit=100), pieces._model())
    assert out.columns == ["doc_id", "text", "ids", "decoded"] and out.count() == len(texts) + 1
    once = pieces.encode(df, pieces._model(), decoded="decoded", table_limit=100)
    assert sorted(map(str, once.collect())) == sorted(map(str, out.collect()))
    for r in out.collect():
        want = processor.encode(texts[r.doc_id] or "")
        assert list(r.ids) == want and r.decoded == processor.decode(want)


def test_pieces_of_an_empty_table(docs):
    assert pieces.digests(docs.limit(0), pieces._model()).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert pieces.digests(docs.limit(0), pieces._model()).count() == 0


def test_op2(spark, sf, docs, processor):
    import hashlib

    got = {r.doc_id: r for r in pieces.op2_sentencepiece(spark, sf).collect()}
    for d in docs.collect():
        ids = processor.encode(d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), processor.decode(ids))])


# near copies

def brute_groups(texts):
    prints = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            a, b = root(i), root(j)
            group[max(a, b)] = min(a, b)
    return prints, [root(i) for i in range(len(texts))]


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2, 4):
        masks, rnd = simhash.covering_masks(radius), random.Random(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            differing = sum(1 << i for i in rnd.sample(range(64), radius))
            assert any(not m & differing for m in masks)


@pytest.mark.parametrize("block", [3, 512])
def test_links_keep_components(spark, block):
    rnd, prints = random.Random(7), set()
    for _ in range(40):  # chains around some centres, and a crowd that shares most tables
        at = rnd.getrandbits(64)
        for _ in range(12):
            prints.add(at)
            at ^= sum(1 << i for i in rnd.sample(range(64), rnd.choice([1, 3, 4, 5])))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = components.components(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4, block))
    got = {r.node: r.root for r in found.collect()}
    group = {s: s for s in signed}

    def root(s):
        while group[s] != s:
            s = group[s]
        return s

    for a, b in combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    for s in signed:
        assert got.get(s, s) == root(s)


def test_no_entry_of_all_tables_is_broadcast(spark):
    """However few fingerprints there are: Spark sizes their 31 entries each as one."""
    prints = simhash.saved(spark.range(500).select(F.xxhash64("id").alias("fp")), "test-prints")
    assert exploded_in_broadcasts(prints.select("fp", F.explode(F.sequence(F.lit(1), F.lit(31))).alias("v")).hint("broadcast").join(prints, "fp"))
    assert not exploded_in_broadcasts(simhash.links(prints, 4))


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 180)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain + star + chain + [(5, 5)], "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 180)} == {100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_groups_equal_brute_force(spark, docs):
    texts = [None, "", " ", "a", "A b", "a  b\tc", LONG] + [r.text for r in docs.orderBy("doc_id").collect()]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, "a", 1)], "doc_id long, text string, fp long")
    got = {r.doc_id: r for r in simhash.near_groups(df).collect()}
    prints, groups = brute_groups(texts)
    assert [got[i].fp % 2**64 for i in range(len(texts))] == prints
    assert [got[i].component_id for i in range(len(texts))] == groups


def test_one_row_of_each_group_stays(rows, spark):
    text, other = "one two three four five six", "seven eight nine ten eleven"
    df = rows(DOC, (4, text, "en", "a", 1), (4, text, "en", "a", 1), (2, text, "en", "b", 1), (None, text, None, None, 1),
              (None, other, "x", None, 2), (9, None, None, None, 0), (8, "", None, None, 0))
    got = simhash.first_of_groups(spark, df, "")
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [("2", text), ("8", ""), ("None", other)]
    assert simhash.first_of_groups(spark, df.limit(0), "").count() == 0


# language

def test_languages_of_documents(docs):
    got = langid.identified(docs.withColumn("confidence", F.lit("clash")))
    assert got.filter("accepted and language = lang").count() == docs.count()


def test_evidence_decides_where_text_is_short(spark, docs):
    odd = spark.createDataFrame([
        (-1, None, "en", "src0", 0), (-2, "", "en", "src0", 0), (-3, "12 34 !!", "de", "src0", 0),
        (-4, "Жизнь прекрасна и удивительна всегда для нас", "en", "src0", 0), (-5, "the and of that with", None, None, 0),
        (-6, "que", "fr-CA", "src1", 0), (-7, "que", "es_MX", "src1", 0), (-8, "the of and " * 20_000, "not a tag", "", 0)], DOC)
    all_docs = docs.unionByName(odd).unionByName(odd)
    got = {r.doc_id: r for r in langid.identified(all_docs).filter("doc_id < 0").collect()}
    assert not any(got[i].accepted for i in (-1, -2, -3, -4)) and got[-4].language == "und" and got[-1].language is None
    assert [got[i].language for i in (-5, -6, -7, -8)] == ["en", "fr", "es", "en"]
    kept = langid.known_language(spark, all_docs, "")
    assert kept.columns == docs.columns and kept.filter("doc_id >= 0").count() == docs.count()


def test_languages_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn("want", F.regexp_extract("html", '<html[^>]*lang="?([^">]*)', 1))
    got = langid.language_of_pages(spark, sf).join(pages, "page_id")
    assert got.filter("language <> want").count() == 0 and got.count() == pages.count()


def test_markup_is_read_whatever_it_holds():
    page = "<!DOCTYPE html><HTML data-x=1 Lang='fr-CA'><head><title>t</title></head><body>a<script>b<p>c</script ><!-- d > e -->f &amp; &eacute;<br>g"
    lang, text = langid.shown(page)
    assert lang == "fr-CA" and text.split() == ["a", "f", "&", "é", "g"]
    assert langid.shown("no markup < 3") == (None, "no markup ") and langid.shown("<html><p lang=de>x")[0] is None
    assert langid.shown("İ<script>x</script>y<b>")[1].split() == ["İ", "y"]
    for long in ("<script>" * 100_000, "<" * 1_000_000, "<!--" * 300_000, "<html " + "a" * 1_000_000):
        langid.shown(long)


def plain_posteriors(docs, model):
    """Language and confidence of each (text, tag, host), from the definitions, document by document."""
    names = [*model.languages, "und"]
    size = len(names)
    soft = lambda x: (lambda e: e / e.sum())(np.exp(x - np.max(x)))
    logs = []
    for text, _, _ in docs:
        raw = (text or "").lower().encode()
        counts = np.zeros(langid.BUCKETS)
        for i in range(len(raw) - 2):
            counts[(raw[i] * 7919 + raw[i + 1] * 263 + raw[i + 2]) % langid.BUCKETS] += 1
        table = np.repeat(model.floors[:, None], langid.BUCKETS, 1)
        for b in range(langid.BUCKETS):
            for e in range(model.starts[b], model.starts[b + 1]):
                table[model.language[e], b] += model.more[e]
        own = np.append(table @ counts, -np.log(langid.BUCKETS) * counts.sum()) * langid.TEMPER
        logs.append(own if any(map(str.isalpha, text or "")) else None)
    ps = [None if x is None else soft(x) for x in logs]
    some = [p for p in ps if p is not None]
    total = np.sum(some, 0)
    overall = (total + 1) / (total.sum() + size)
    overall[-1] = langid.NONE_PRIOR
    overall /= overall.sum()
    k, zero = langid.KAPPA, np.zeros(size)
    known = lambda t: t if t in model.languages or t is None else "other"
    domain = lambda h: ".".join(h.split(".")[-2:])
    suffix = lambda h: h.split(".")[-1] if "." in h else None
    of = lambda key, value: sum((p for (_, t, h), p in zip(docs, ps) if p is not None and key(t, h) == value), zero)
    found = []
    for (_, tag, host), x, p in zip(docs, logs, ps):
        if p is None:
            found.append((None, None))
            continue
        d = np.maximum(of(lambda t, h: domain(h), domain(host)) - p, 0)
        d = (d + k * overall) / (d.sum() + k)
        n = np.maximum(of(lambda t, h: h, host) - p, 0)
        at = overall if not host else d if domain(host) == host else (n + k * d) / (n.sum() + k)
        total_of = x + np.log(at)
        if tag is not None:
            says = of(lambda t, h: known(t), known(tag))
            total_of = total_of + np.log((says + k * (says.sum() + 1) / (total.sum() + size)) / (total + k))
        if suffix(host):
            under = of(lambda t, h: suffix(h), suffix(host))
            total_of = total_of + np.log((under + k * (under.sum() + 1) / (total.sum() + 1)) / (total + k))
        post = soft(total_of)
        best = names[int(np.argmax(post))]
        found.append((tag if (best == "und" or post.max() < 0.5) and known(tag) == "other" else best, post.max()))
    return found


def test_posteriors_equal_plain_ones(rows):
    rnd = random.Random(8)
    words = {"en": "the of and that with for".split(), "de": "der die und nicht ein".split(), "fr": "le les que une dans".split()}
    hosts = ["a.x.de", "b.x.de", "x.de", "y.com", "m.y.com", "", "bare"]
    docs = []
    for i in range(90):
        lang = rnd.choice(list(words))
        text = " ".join(rnd.choice(words[rnd.choice([lang, lang, "en"])]) for _ in range(rnd.randint(1, 4)))
        docs.append((rnd.choice([text, text, text, None, "12 !", "Жизнь пр"]) if i > 30 else text, rnd.choice([lang, lang, None, "xx", "yy"]) if i > 30 else lang, rnd.choice(hosts)))
    ddl = "doc_id long, text string, lang string, source string, host string, tag int, row int, logs int, n int, p int"
    df = rows(ddl, *[(i, t, l, s, "h", 1, 2, 3, 4, 5) for i, (t, l, s) in enumerate(docs)]).repartition(3)
    got = {r.doc_id: r for r in langid.identified(df).collect()}
    want = plain_posteriors(docs, langid.fit(df))
    for i, (language, confidence) in enumerate(want):
        assert got[i].language == language and (confidence is None or abs(got[i].confidence - confidence) < 1e-6), (i, docs[i], got[i], want[i])
    assert got[0].host == "h" and got[0].p == 5 and {r.language for r in got.values()} >= {"en", "de", "fr"}


def test_many_declared_languages_all_have_models(rows):
    tags = [a + b for a in "abcdefghij" for b in "klmnopqrst"]  # a hundred
    df = rows(DOC, *[(10 * i + k, f"{t * 3} {t}{t[::-1]} {t}x{t}", t, None, 0) for i, t in enumerate(tags) for k in range(6)],
              (5000, "Жизнь прекрасна и удивительна", "ru", None, 0))
    model = langid.fit(df)
    assert model.languages == sorted(tags)
    got = langid.identified(df)
    assert got.filter("doc_id < 5000 and language = lang and accepted").count() > 590
    assert got.filter("doc_id = 5000").select("language", "accepted").first()[:] == ("ru", True)  # no model, taken at its word


def test_language_of_an_empty_table(spark, docs):
    assert langid.known_language(spark, docs.limit(0), "").count() == 0


# personal data

def brute_spans(text):
    return [(k, m.start(), m.end()) for k, p in disclosure.PATTERNS.items() for m in re.finditer(p, text) if disclosure._passes(k, m[0])]


def test_base_spans_equal_plain_patterns():
    rnd, finder = random.Random(4), disclosure.Finder()
    bits = ["a", "@", ".", "-", "1", "25", "+", " ", "(", "é", "@b.c", "4111111111111111", "%", "255", "\n"]
    for _ in range(20_000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert finder.base(t) == brute_spans(t)


def test_op7_base(spark, sf, docs):
    import hashlib

    got = {r.doc_id: r for r in disclosure.op7_pii(spark, sf).collect()}
    for d in docs.collect():
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in brute_spans(d.text))
        assert got[d.doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert got[d.doc_id].spans.startswith(want)


def test_terms_that_disclose(rows, spark):
    told = [(i, f"word{i} the Marigold, wrote a@b.org about it{i}", "en", "s", 1) for i in range(4)]
    others = [(10 + i, f"the plain text about nothing {i}", "en", "s", 1) for i in range(40)]
    odd = [(90, None, None, None, 0), (91, "", "en", "s", 0), (92, "x +1 (974) 555-3436 y" + LONG, "en", "s", 0)]
    df = rows(DOC, *told, *others, *odd, told[0])
    spans = {r.doc_id: r for r in disclosure.spans_of(df).collect()}
    for i, text, *_ in told:
        assert {text[t.start:t.end] for t in spans[i].terms} == {"Marigold", "wrote"}  # in no other document
    assert not any(spans[r[0]].terms for r in others)  # documents without the entity are left alone
    clean = {r.doc_id: r for r in disclosure.without_personal_data(spark, df.withColumn("base", F.lit(1)), "").collect()}
    assert clean[1].text == "word1 the ,  <EMAIL> about it1" and clean[1].n_chars == len(clean[1].text)
    assert clean[92].text.startswith("x <PHONE> y") and clean[90].text is None and clean[10].text == others[0][1]
    assert len(clean) == 47 and clean[1].base == 1
    assert disclosure.without_personal_data(spark, df.limit(0), "").count() == 0


def test_terms_far_from_the_entity_and_in_documents_without_it(rows):
    filler = "plain words stand here for a while and say nothing at all about anyone"
    told = [(i, f"a@b.org {filler} {filler} Marigold", "en", "s", 1) for i in range(5)]
    alone, others = (9, f"(Marigold) {filler}", "en", "s", 1), [(10 + i, f"{filler} w{i}", "en", "s", 1) for i in range(200)]
    twice = [(300 + i, f"c@d.org {filler} Zephyr", "en", "s", 1) for i in range(2)]
    once = (400, f"e@f.org {filler} Hapax", "en", "s", 1)
    df = rows(DOC, *told, alone, *others, *twice, once)
    text = {r.doc_id: r.text for r in df.collect()}
    spans = {r.doc_id: {text[r.doc_id][t.start:t.end] for t in r.terms or []} for r in disclosure.spans_of(df).collect()}
    assert all(spans[i] == {"Marigold"} for i in (0, 1, 2, 3, 4, 9)) and not any(spans[r[0]] for r in others)
    assert spans[300] == spans[301] == {"Zephyr"}  # no least number of documents
    assert not spans[400]  # one document does not tell which of its words gives away the entity


def test_disclosed_shares_equal_plain_ones(rows):
    import math
    from zlib import crc32

    rnd = random.Random(6)
    docs = []
    for i in range(400):
        words = [f"w{rnd.randint(0, 60)}" for _ in range(6)]
        if i % 8 == 0:
            words += [f"p{i}@{'ab'[i % 16 // 8]}.org", rnd.choice(["Alpha", "Beta", "Gamma" if i % 16 else "Delta"]), "mail"]
        if i % 50 == 3:
            words += ["+1 974 555 1234", "Omega"]
        docs.append((i, " ".join(words), None, None, i))
    docs += [docs[8]] * 3 + [(None, None, None, None, 0)]
    finder = disclosure.Finder()
    of_names, of_terms, of_both, vocabulary, n = {}, {}, {}, set(), len(docs)
    for _, text, *_ in docs:
        base = finder.base(text or "")
        names = {p for k, s, e in base for p in disclosure.protected(k, text[s:e])}
        whole = {finder.term(t).lower() for t in (text or "").split()} - {""}
        inside = {t for t, _, _ in finder.places(text, base, disclosure.term_of)} if base else set()
        vocabulary |= {t for t in whole if crc32(t.encode()) % disclosure.PICKED == 0}
        for t in whole:
            of_terms[t] = of_terms.get(t, 0) + 1
        for p in names:
            of_names[p] = of_names.get(p, 0) + 1
            for t in inside:
                of_both[p, t] = of_both.get((p, t), 0) + 1
    tried = max(disclosure.PICKED * len(vocabulary), len({t for _, t in of_both}))
    want = {}
    for (p, t), both in of_both.items():
        prior, seen = of_names[p] / n, both / of_terms[t]
        kl = sum(x * math.log2(x / y) for x, y in ((seen, prior), (1 - seen, 1 - prior)) if x > 0) if seen > prior else 0.0
        chance = 2.0 ** (-of_terms[t] * kl)
        odds = tried * (-math.e * chance * math.log(chance) if 0 < chance < 1 / math.e else 1.0 if chance else 0.0)
        share = math.log2((seen + odds * prior) / (1 + odds) / prior) / -math.log2(prior)
        low, high = disclosure.LEVELS[p[0]]
        if share >= low:
            want[t] = want.get(t, False) or share >= high
    df = rows(DOC, *docs)
    keyed = df.select("doc_id", F.xxhash64("doc_id").alias("key"), "text").repartition(4)
    got = {r.term: r.removed for r in disclosure.disclosing(disclosure.noted(keyed).withColumn("row", F.monotonically_increasing_id()), keyed.select("text")).collect()}
    assert got == want and want["mail"] and "omega" in want and "w1" not in want and "delta" in want


def test_no_name_of_a_document_is_broadcast_unmeasured(rows, monkeypatch):
    df = rows("doc_id long, key long, text string", *[(i, i, f"mail x{i}@a.org from 10.0.0.{i} to the secret{i} plan") for i in range(20)])
    seen, write = [], disclosure.saved
    monkeypatch.setattr(disclosure, "saved", lambda made, name: seen.append((name, made)) or write(made, name))
    found = write(disclosure.noted(df).withColumn("row", F.monotonically_increasing_id()), "test-found")
    disclosure.disclosing(found, df.select("text"))
    assert [name for name, _ in seen] == ["disclosing-pairs", "term-counts", "disclosing"]
    assert not [x for _, made in seen for x in exploded_in_broadcasts(made)]


def test_the_bitmap_holds_every_term(spark):
    terms = [f"t{i}é" for i in range(3000)]
    table = disclosure.Terms(disclosure.bitmap(spark.createDataFrame([(t,) for t in terms], "term string")).value, False)
    assert all(table[f"({t.upper()}),"] == t for t in terms) and sum(bool(table[f"no{i}"]) for i in range(3000)) < 3


def test_disclosing_terms_are_generalised_to_their_shape():
    text = "Anna met NATO at K2 with friends a@b.org"
    marks = [{"start": s, "end": e, "removed": s == 0 and False} for s, e in ((0, 4), (9, 13), (17, 19), (25, 32))]
    base = [{"kind": 0, "start": 33, "end": 40}]
    assert disclosure._replaced(text, base, marks) == "<NAME> met <ABBREVIATION> at <CODE> with <WORD> <EMAIL>"
    assert disclosure._replaced(text, base, [{"start": 0, "end": 4, "removed": True}]) == " met NATO at K2 with friends <EMAIL>"


def test_columns_named_like_inner_ones_pass_through(rows, spark):
    df = rows("doc_id long, text string, base string, terms int, key string, row int, id long, of_key int",
              (1, "a@b.org x", "b", 1, "k", 2, 3, 4), (None, "a@b.org y", None, None, None, None, None, None), (None, None, "n", 1, "k", 2, 3, 4))
    got = sorted(map(tuple, disclosure.sanitised(df).collect()), key=str)
    assert got == sorted([(1, "<EMAIL> x", "b", 1, "k", 2, 3, 4), (None, "<EMAIL> y", None, None, None, None, None, None), (None, None, "n", 1, "k", 2, 3, 4)], key=str)


def test_odd_long_texts_take_no_long():
    import time

    finder, model = disclosure.Finder(), langid.model_of(["aa", "bb"], np.array([0, 1]), np.array([5, 9]), np.array([3, 4]))
    for long in ("1" * 1_000_000, "." * 1_000_000, "a" + "." * 1_000_000 + "a", "1." * 500_000, "+1" + "(" * 1_000_000, "a@" * 500_000,
                 "1 " * 500_000, "a." * 500_000 + "@", "1.1." + "1" * 1_000_000, "\u0130" * 300_000):
        began = time.time()
        base = finder.base(long)
        finder.places(long, base, disclosure.term_of)
        model.evidence(long)
        assert time.time() - began < 4, long[:20]


def test_an_address_part_of_many_zeros():
    zeros = "0" * 5000
    assert disclosure.Finder().base(f"1.2.3.{zeros}") == [("ip", 0, 5006)]
    assert disclosure.Finder().base(f"1.2.{zeros}7.4")[0][0] == "ip" and not disclosure.Finder().base(f"1.2.{zeros}256.4")
