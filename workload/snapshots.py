"""Snapshot archives written from the supplied tables, for the archive queries.

Every task writes the archive of its own partition, so no table passes through
one place; the archives of one folder together hold whole tables.
"""

from __future__ import annotations

import tarfile
import zipfile
from itertools import chain, groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quayside.operators.spread import shuffle_partitions
from quayside.session import sent_with_jobs
from quayside.sources.files import open_output

sent_with_jobs(__name__)


def as_csv(df: DataFrame, member: str) -> DataFrame:
    """(member, header, line): each row as quoted CSV text."""
    text = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return text.select(
        F.lit(member).alias("member"), F.lit(",".join(df.columns)).alias("header"),
        F.to_csv(F.struct(*text.columns), {"quoteAll": "true", "escape": '"', "nullValue": "", "emptyValue": ""}).alias("line"),
    )


class _Read:
    """Pieces of bytes as a file to read from."""

    def __init__(self, pieces):
        self.pieces, self.left = pieces, b""

    def read(self, n: int) -> bytes:
        while len(self.left) < n and (piece := next(self.pieces, None)) is not None:
            self.left += piece
        taken, self.left = self.left[:n], self.left[n:]
        return taken


def write_archives(lines: DataFrame, folder: str, kind: str, *, junk: bytes = b"") -> DataFrame:
    """Write <folder>/part-<n>.zip or .tar.gz; returns (path). `junk` bytes are put before each line's end.

    Lines are dealt out by hash to as many archives as a shuffle has partitions,
    and streamed into the open member, so no archive is ever held whole.
    """
    ways, end = shuffle_partitions(lines), junk + b"\r\n"
    dealt = lines.withColumn("archive", F.pmod(F.xxhash64("line"), F.lit(ways)))
    # a tar names a member's size ahead of its bytes
    sizes = dealt.groupBy("archive", "member", "header").agg(
        (F.sum(F.octet_length("line") + len(end)) + F.octet_length("header") + 2).alias("size"))
    whole = dealt.join(sizes, ["archive", "member", "header"]).repartition(ways, "archive").sortWithinPartitions("archive", "member", "header")

    def write(frames):
        rows = (r for f in frames for r in zip(f["archive"], f["member"], f["header"], f["size"], f["line"]))
        for archive, own in groupby(rows, itemgetter(0)):
            path = f"{folder}/part-{archive:05d}{'.zip' if kind == 'zip' else '-DATA.sql.gz'}"
            with open_output(path) as raw, (
                    zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) if kind == "zip" else tarfile.open(fileobj=raw, mode="w|gz")) as out:
                for (member, header, size), some in groupby(own, itemgetter(1, 2, 3)):
                    pieces = chain([header.encode() + b"\r\n"], (r[4].encode() + end for r in some))
                    if kind == "zip":
                        with out.open(member, "w") as stream:
                            for piece in pieces:
                                stream.write(piece)
                    else:
                        info = tarfile.TarInfo(member)
                        info.size = size
                        out.addfile(info, _Read(pieces))
            yield pd.DataFrame({"path": [path]})

    return whole.select("archive", "member", "header", "size", "line").mapInPandas(write, "path string")
