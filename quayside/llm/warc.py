"""Web archives: one gzip member per record, written by tasks and read back by byte ranges.

Writing. Each task streams its rows into one file of its own name. Of rows with
equal payloads of at least `min_bytes` bytes the one with the largest id is a
response, the others revisit it; smaller payloads are all responses.

Reading. Files are cut into byte ranges, one task each, without an index. A
task scans its range for the gzip magic and takes a place for the start of a
record if a member can be decoded there and begins as a WARC record does. It
owns the records that start inside its range and reads the last one to its end
beyond it; after a record the scan goes on where its member ended. One record
at a time is in memory.

Files are reached through Arrow's file systems (local, HDFS, S3, GCS).

Defined results: a null payload counts as empty; a null address is left out, line
breaks in one are escaped; a
null id gives a null id back, and never names a response others could be told
from; rows that repeat an id with an equal payload are responses alike; an
empty table writes and reads nothing; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayside.llm.common import read, saved
from quayside.session import new_folder, sent_with_jobs
from quayside.sources.files import open_output, open_seekable

sent_with_jobs(__name__)

MIN_BYTES = 1000
RANGE_BYTES = 16 << 20
VERSION, MAGIC, LINE = b"WARC/1.1", b"\x1f\x8b\x08", b"\r\n"
RECORD = "urn:page:"
ROW = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
       "target_uri string, payload binary")


def _decided(pages: DataFrame, id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("target_uri"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload")).withColumn(
        "size", F.octet_length("payload").cast("long"))
    shared = saved(rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "equal-payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to")
    return rows.join(shared, ["digest", "size"], "left").select("page_id", "target_uri", "payload", "digest", refers)


def write_archives(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write `pages` as archives under `folder`; returns path and bytes of each file that counts.

    A task that is run again writes a file under another name, so the list, not
    the folder, says what was written.
    """
    def run(batches):
        import uuid

        import pyarrow as pa

        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        out, size = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out = open_output(path)
                member = packed(row)
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size}])

    return saved(_decided(pages, id, url, html, min_bytes).mapInArrow(run, "path string, bytes long"), "archive-list")


def packed(row: dict) -> bytes:
    """One record as a gzip member."""
    import base64
    import zlib

    payload, revisit = row["payload"], row["refers_to"] is not None
    name = lambda i: f"<{RECORD}{'' if i is None else i}>".encode()
    block = LINE.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                       b"Content-Length: %d" % len(payload), b"", b"" if revisit else payload])
    head = [VERSION, b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + name(row["page_id"]),
            b"WARC-Date: 1970-01-01T00:00:00Z", b"Content-Type: application/http; msgtype=response",
            b"WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(row["digest"])),
            b"Content-Length: %d" % len(block)]
    if row["target_uri"] is not None:
        head.append(b"WARC-Target-URI: " + row["target_uri"].replace("\r", "%0D").replace("\n", "%0A").encode())
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 b"WARC-Refers-To: " + name(row["refers_to"])]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(LINE.join([*head, b"", block, b"", b""])) + squeeze.flush()


def members(file, start: int, end: int, chunk: int = 1 << 20):
    """Decoded records whose members start in [start, end) of an open file."""
    import zlib

    held, at = b"", start  # bytes of the file from place `at`

    def more() -> bool:
        nonlocal held
        file.seek(at + len(held))
        got = file.read(chunk)
        held += got
        return bool(got)

    while True:
        found = held.find(MAGIC)
        if found < 0:  # the magic may lie across two reads
            drop = max(0, len(held) - len(MAGIC) + 1)
            held, at = held[drop:], at + drop
            if at >= end or not more():
                return
            continue
        held, at = held[found:], at + found
        if at >= end:
            return
        unpack, parts, taken, size = zlib.decompressobj(31), [], 0, 0
        try:
            while not unpack.eof:
                if taken == len(held) and not more():
                    raise zlib.error("the file ends inside a member")
                parts.append(unpack.decompress(held[taken:]))
                taken, size = len(held) - len(unpack.unused_data), size + len(parts[-1])
                if size >= len(VERSION) and not b"".join(parts[:9])[:7] == VERSION[:7]:
                    raise zlib.error("not a record")
            record = b"".join(parts)
            if not record.startswith(VERSION[:7]):
                raise zlib.error("not a record")
        except zlib.error:  # bytes that look like the magic
            held, at = held[1:], at + 1
            continue
        yield record
        held, at = held[taken:], at + taken


def parsed(record: bytes, payloads: bool) -> dict:
    """The row of a decoded record; a response's digest and length are those of the payload read."""
    import base64
    import hashlib

    def headers(lines: bytes) -> dict[bytes, bytes]:
        pairs = (line.partition(b":") for line in lines.split(LINE)[1:])
        return {k.strip().lower(): v.strip() for k, _, v in pairs}

    def numbered(name: bytes | None):
        digits = (name or b"").strip(b"<>").decode().removeprefix(RECORD)
        return int(digits) if digits else None

    head, _, rest = record.partition(LINE * 2)
    warc = headers(head)
    block = rest[:int(warc[b"content-length"])]
    http, _, payload = block.partition(LINE * 2)
    stated = base64.b32decode(warc[b"warc-payload-digest"].partition(b":")[2]).hex()
    kind = warc[b"warc-type"].decode()
    if kind == "response":
        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
        if digest != stated:
            raise ValueError(f"record {warc[b'warc-record-id']!r}: payload does not have its digest")
    else:
        digest, size = stated, int(headers(http)[b"content-length"])
    uri = warc.get(b"warc-target-uri")
    return {"page_id": numbered(warc[b"warc-record-id"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": numbered(warc.get(b"warc-refers-to")),
            "target_uri": None if uri is None else uri.decode(),
            "payload": payload if payloads and kind == "response" else None}


def read_archives(listed: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """Records of the archives in `listed` (path, bytes), read by ranges of `range_bytes`."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    cut = listed.select("path", F.explode(starts).alias("start"))
    tasks = listed.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1  # one range each

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                with open_seekable(row["path"]) as file:
                    rows, held = [], 0
                    for record in members(file, row["start"], row["start"] + range_bytes):
                        rows.append(parsed(record, payloads))
                        held += len(record) if payloads else 256
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=_arrow())
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=_arrow())

    return cut.repartition(int(tasks)).mapInArrow(run, ROW)


def _arrow():
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ROW.split(", "))])


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = write_archives(read(spark, sf_dir, "pages"), new_folder(spark, "archives"))
    return read_archives(listed, payloads=False).drop("payload", "target_uri")


QUERIES = {"op4_warc": op4_warc}
ORACLE = {"op4_warc": f"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
    FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < {MIN_BYTES} OR page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id <> largest THEN largest END AS refers_to
FROM p
"""}
