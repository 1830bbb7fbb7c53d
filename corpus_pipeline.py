"""From raw documents to token ids: language, near copies, personal data, mixture, sub-word pieces.

Each stage is written as Parquet to the shared folder and read back as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.common import read, saved, scratch
from quayside.llm.disclosure import without_personal_data
from quayside.llm.langid import known_language
from quayside.llm.mixing import mix_stage
from quayside.llm.pieces import encoded
from quayside.llm.simhash import first_of_groups

STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", first_of_groups),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mix_stage),
    ("SentencePiece encoding and decoding", encoded),
]

# learned models and hashes are beyond SQL; tests/llm checks the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage saved on the way is removed once it is written, and its input with it."""
    docs, before = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch(spark) as made:
            docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
            own = made.pop()  # the last one is the stage's result
            made += before
            before = [own]
    return docs
