"""Sub-word ids of whole texts, and texts of ids, by a table of distinct chunks.

The model's pieces hold the blank marker only in front, and none holds a line
feed. So no merge ever joins what stands before a marker or a line feed with
it, and a text may be cut there: a chunk is a run of markers and the characters
after it, or a line feed and the characters after it. Each task segments each
distinct chunk once, keeps its ids in a table, and joins the ids back to the
texts by the chunks' positions. Texts never leave their task: there is no
shuffle, and memory is bounded by the table's limit.

Defined results: a null text counts as empty and has no ids; an empty text has
no ids and decodes to an empty text; null ids decode to an empty text; repeated
rows and an empty table are nothing special; other columns pass through, and a
column named like the result gives way to it.
"""

from __future__ import annotations

import itertools
from itertools import pairwise

from pyspark.sql import DataFrame, functions as F, types as T

from quayside.llm.common import appended, read, slices, with_arrays
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

MARK = "▁"


def _cutter():
    """text -> its chunks, each without its own first marker; only a chunk that begins with a line feed has none."""
    import re

    runs = re.compile(f"[ {MARK}]+[^ {MARK}\n]*|\n[^ {MARK}\n]*")

    def cut(text: str) -> list[str]:
        if not text:
            return []
        if text[0] == " " or MARK in text or "  " in text:
            return [c if c[0] == "\n" else c[1:] for c in runs.findall(" " + text)]
        chunks: list[str] = []
        for i, line in enumerate(text.split("\n")):  # no two markers in a row
            parts = line.split(" ")
            if i:
                parts[0] = "\n" + parts[0]
            chunks += parts
        return chunks

    return cut


def cuts_are_safe(processor) -> bool:
    """Whether no piece of the model reaches across the places where texts are cut, and none is rewritten before."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    ordinary = not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
    sample = "ﬁ　 Á  b "  # ligature, wide blank, combining mark, double and last blank: nothing may be rewritten
    return ordinary and processor.decode(processor.encode(sample)) == sample


class ChunkTable(dict):
    """chunk -> place in a flat list of ids; a chunk asked for the first time gets its place at once, its ids with `segment`."""

    def __init__(self, processor, limit: int):
        import numpy as np

        self.processor, self.limit, self.np = processor, limit, np
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.new, self.chars = [], 0
        self.ids, self.ends = self.np.empty(0, self.np.int32), self.np.zeros(1, self.np.int64)

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = place = len(self)
        return place

    def full(self) -> bool:
        """At the limit, or at 64 characters for each place under it."""
        return len(self) > self.limit or self.chars > 64 * self.limit

    def segment(self) -> None:
        if not self.new:
            return
        np = self.np
        # the library puts a marker before each text: it is the chunk's own first one, or one to drop
        found = self.processor.encode(self.new, num_threads=1)
        mark = [self.processor.piece_to_id(MARK)]  # a chunk that is one marker: the library gives an empty text no ids
        found = [ids[1:] if c[:1] == "\n" else ids or mark for c, ids in zip(self.new, found)]
        ends = self.ends[-1] + np.cumsum([len(ids) for ids in found], dtype=np.int64)
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(found), np.int32)])
        self.ends = np.concatenate([self.ends, ends])
        self.chars += sum(map(len, self.new))
        self.new = []

    def spread(self, places):
        """Ids of the chunks at `places`, one after another, and how many each has."""
        np = self.np
        starts = self.ends[places]
        counts = self.ends[places + 1] - starts
        first = np.cumsum(counts) - counts
        return self.ids[np.repeat(starts - first, counts) + np.arange(counts.sum())], counts


def encode(docs: DataFrame, model: str, text: str = "text", into: str = "ids", decoded: str | None = None,
           table_limit: int = 100_000) -> DataFrame:
    """`docs` with the ids of each whole text, as the model's library gives them without begin and end ids.

    `decoded` names a column for the text the ids decode to, made in the same pass.
    """
    out = appended(docs.schema, T.StructField(into, T.ArrayType(T.IntegerType(), False), False))
    if decoded:
        out = appended(out, T.StructField(decoded, T.StringType(), False))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        if not cuts_are_safe(processor):
            raise ValueError(f"{model}: pieces may cross blanks, texts cannot be cut there")
        table, cut = ChunkTable(processor, table_limit), _cutter()
        for batch in slices(batches, text):
            if table.full():
                table.empty()
            chunks = [cut(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            places = np.fromiter(map(table.__getitem__, itertools.chain.from_iterable(chunks)), np.int64)
            table.segment()
            ids, counts = table.spread(places)
            upto = np.concatenate([[0], np.cumsum(counts)])  # ids before each chunk
            offsets = upto[np.concatenate([[0], np.cumsum([len(c) for c in chunks], dtype=np.int64)])].astype(np.int32)
            arrays = {into: pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))}
            if decoded:
                arrays[decoded] = pa.array([processor.decode(ids[a:b].tolist()) if b > a else "" for a, b in pairwise(offsets.tolist())], pa.string())
            yield with_arrays(batch, out.names, arrays)

    return docs.mapInArrow(run, out)


def decode(docs: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`docs` with the text of each row's ids."""
    out = appended(docs.schema, T.StructField(into, T.StringType(), False))

    def run(batches):
        import pyarrow as pa
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            texts = [processor.decode(row.values.to_numpy().tolist()) if row.is_valid and len(row) else "" for row in column]
            yield with_arrays(batch, out.names, {into: pa.array(texts, pa.string())})

    return docs.mapInArrow(run, out)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """One row per document: how many ids, and digests of the ids and of the text they decode to."""
    both = encode(docs.select("doc_id", "text"), model, decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def _model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark, sf_dir):
    return digests(read(spark, sf_dir, "documents"), _model())


def encoded(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: a row per row of `docs`, with how many ids its text has and the digests."""
    return digests(docs, _model())


QUERIES = {"op2_sentencepiece": op2_sentencepiece}
ORACLE: dict[str, str] = {}
