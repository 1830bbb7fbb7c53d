"""The pipeline, each stage against brute force on its own input, and what is left without the subpackage."""

import hashlib
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import disclosure, mixing, pieces
from quayside.llm.common import saved
from test_llm_text import brute_groups

ROOT = Path(__file__).parents[2]


def test_every_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    junk = [(-1, None, "en", "src0", 0), (-2, "12 %% 34", None, None, 8), (-2, "12 %% 34", None, None, 8),
            (-3, "Жизнь прекрасна и удивительна всегда", "en", "src0", 36)]
    given = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    def after(name, df):
        out = saved(stages[name](spark, df, sf), "test-stage")
        return out, {r.doc_id: r for r in out.collect()}

    one, rows = after("language ID", given)
    assert one.columns == docs.columns and set(rows) == {r.doc_id for r in docs.collect()}
    before = sorted(one.collect(), key=lambda r: r.doc_id)
    two, rows = after("SimHash near-dedup", one)
    groups = brute_groups([r.text for r in before])[1]
    assert set(rows) == {r.doc_id for i, r in enumerate(before) if groups[i] == i}
    assert two.columns == docs.columns and two.count() == len(rows)
    three, clean = after("PII", two)
    assert three.columns == docs.columns and set(clean) == set(rows)
    for i, r in rows.items():
        text = r.text
        if not any(True for _ in disclosure.Finder().base(text)):
            assert clean[i].text == text
        else:
            assert not disclosure.Finder().base(clean[i].text) and clean[i].n_chars == len(clean[i].text)
    four, _ = after("mixing sources to target weights", three)
    con = duckdb.connect()
    frame = three.toPandas()
    con.register("documents", frame)
    want = {i: t // s for i, s, t in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE['op8_mixing']}) WHERE taken > 0").fetchall()}
    got = {r.doc_id: r.n for r in four.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert four.columns == docs.columns and got == want
    five, ids = after("SentencePiece encoding and decoding", four)
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=pieces._model())
    assert five.count() == four.count()
    for r in four.collect():
        assert ids[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, processor.encode(r.text))).encode()).hexdigest()


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "n_tokens"} <= set(out.columns) and out.count() > 0


def test_the_rest_works_without_the_subpackage(tmp_path):
    left = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=left)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries())"], cwd=tmp_path / "repo",
                          capture_output=True, text=True, check=True).stdout
    assert "vw_daily_rentals" in said and "op8_" not in said and "pipeline" not in said


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("quayside/**/*.py"), *ROOT.glob("workload/*.py"), *ROOT.glob("tests/*.py")]:
        if "llm" not in path.parts:
            assert not re.search(r"quayside\.llm|from quayside import llm", path.read_text()), path
