"""WARC archives: written in segments, read back by reassembly.

A page becomes an HTTP response in chunked transfer framing. A block longer than ``segment`` bytes is cut: the
first segment keeps the response's record, and continuation records name it as origin, count on from 2, and
close with the total length. Of records with equal payloads the one with the largest id is the response, and
the others are revisits of it.

Archives are written by Spark's text writer, whose line separator is the two line breaks that end a record,
so they go to any file system that Spark writes. A record has at most ``segment`` bytes and its header, and a file as
many as make up ``FILE_BYTES``, hence a file fits in memory when it is read. Revisits name the record, date and URI that
they refer to. Digests that several pages have are broadcast up to ``BROADCAST`` rows, beyond that joined by a shuffle.

Reading parses each file once. It groups continuation records by origin identifier, orders them by segment number, verifies that none is
missing and that they make up the total length, takes the chunked framing off, and verifies the payload digest.

Defined results: a null payload is empty and a null url isn't written; null ids rank below all others; rows
that repeat the largest id and payload are all responses; a record that fails a check has ``valid`` false, and a round
trip raises an error then; an empty table gives an empty result; further columns of the input are not archived; ids
of any type are written as text.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.sources.storage import shared_dir, write_shared

SEGMENT, CHUNK, MIN_REVISIT = 8192, 4096, 0
#: Bytes of a file's records before compression, and rows of repeated digests up to which they are broadcast.
FILE_BYTES, BROADCAST = 128 << 20, 1 << 20
_OUT = 8 << 20
_END = b"\r\n\r\n"
_RECORD = "record_id string, record_type string, page_id string, url string, refers_to string, segment int, total_length long, payload_digest string, block binary"


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(data: bytes, size: int) -> bytes:
    parts = [data[at : at + size] for at in range(0, len(data), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunk(data: bytes) -> bytes:
    """The content of chunked framing, extensions and trailers left out; ValueError if it is broken."""
    parts, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            if not data.endswith(b"\r\n"):
                raise ValueError("no end of chunks")
            return b"".join(parts)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk has another length")
        parts.append(data[at : at + size])
        at += size + 2


def header(fields: dict) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(b"%b: %b\r\n" % (k.encode(), str(v).replace("\r", "").replace("\n", "").encode()) for k, v in fields.items() if v is not None)


def segments(fields: dict, block: bytes, size: int) -> Iterator[bytes]:
    """Records, without the line breaks that end them, of one block."""
    parts = [block[at : at + size] for at in range(0, len(block), size)] or [b""]
    for i, part in enumerate(parts):
        own = dict(fields)
        if i:
            own = {"WARC-Type": "continuation", "WARC-Record-ID": f"<{uuid.uuid5(uuid.NAMESPACE_URL, fields['WARC-Record-ID'] + str(i)).urn}>", "WARC-Date": fields["WARC-Date"], "WARC-Segment-Origin-ID": fields["WARC-Record-ID"]}
        if len(parts) > 1:
            own["WARC-Segment-Number"] = i + 1
            if i and i == len(parts) - 1:
                own["WARC-Segment-Total-Length"] = len(block)
        yield header(own | {"Content-Length": len(part)}) + b"\r\n" + part


def _record_id(*parts) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts))).urn}>"


def _writer(segment: int, chunk: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row, out, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page, url, payload, size, sha, winner, winner_url, alone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row += 1
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                # The response that revisits refer to has an id that they know, unless several rows repeat it.
                own = _record_id("response", page, digest) if winner is None and alone else _record_id(page, digest, task, row)
                fields = {"WARC-Type": "response" if winner is None else "revisit", "WARC-Record-ID": own, "WARC-Date": date}
                fields |= {"WARC-Target-URI": url, "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest}", "Page-Id": page}
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if winner is None:
                    http += b"Transfer-Encoding: chunked" + _END + chunked(payload or b"", chunk)
                else:
                    fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _record_id("response", winner, digest) if alone else None}
                    fields |= {"WARC-Refers-To-Target-URI": winner_url, "WARC-Refers-To-Date": date, "Refers-To-Page-Id": winner}
                    http += b"Content-Length: %d" % size + _END
                for record in segments(fields, http, segment):
                    out.append(record)
                    held += len(record)
                    if held > _OUT:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                        out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def write_warc(df: DataFrame, path: str, id_col="page_id", url_col="url", payload_col="html", segment: int = SEGMENT, chunk: int = CHUNK, min_revisit: int = MIN_REVISIT, date: str = "2024-01-01T00:00:00Z", broadcast: int = BROADCAST) -> None:
    """Archive the rows of ``df`` below ``path``, gzipped."""
    pages = df.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    each = pages.where(F.col("size") >= min_revisit).groupBy("sha", "page").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("url"))
    last = F.max(F.struct(F.col("page").isNotNull().alias("known"), "page", "n", "url")).alias("last")
    repeated = each.groupBy("sha").agg(last, F.sum("n").alias("n")).where("n > 1").select("sha", F.col("last.page").alias("winner"), F.col("last.url").alias("winner_url"), (F.col("last.n") == 1).alias("alone"))
    repeated = write_shared(repeated, "repeated")
    joined = pages.join(F.broadcast(repeated) if repeated.count() <= broadcast else repeated, "sha", "left")
    older = F.when(F.col("size") >= min_revisit, F.coalesce(F.col("page") < F.col("winner"), F.col("page").isNull() & F.col("winner").isNotNull()))
    rows = joined.withColumn("winner", F.when(older, F.col("winner").cast("string"))).withColumn("payload", F.when(F.col("winner").isNull(), F.col("payload")))
    rows = rows.select(F.col("page").cast("string").alias("page"), "url", "payload", "size", "sha", "winner", "winner_url", F.coalesce("alone", F.lit(False)).alias("alone"))
    records = rows.mapInArrow(_writer(segment, chunk, date), "record binary").select(F.col("record").cast("string"))
    records.write.option("lineSep", _END.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", max(FILE_BYTES // segment, 1)).text(path)


def parse(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields (lower-cased names) and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(_END, at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one is due")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        at = start + int(fields["content-length"])
        yield fields, data[start:at]
        at += 4


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("segment", pa.int32()), ("total_length", pa.int64()), ("payload_digest", pa.string()), ("block", pa.binary())])
    number = lambda x: None if x is None else int(x)
    table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 9, schema.types, strict=True)], schema=schema)
    for batch in batches:
        for content in batch.column(0):
            data = content.as_py()
            rows: list = []
            held = 0
            for f, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                rows.append((f.get("warc-segment-origin-id", f["warc-record-id"]), f["warc-type"], f.get("page-id"), f.get("warc-target-uri"), f.get("refers-to-page-id"), number(f.get("warc-segment-number")), number(f.get("warc-segment-total-length")), f.get("warc-payload-digest"), block))
                held += len(block)
                if held > _OUT:
                    yield table(rows)
                    rows, held = [], 0
            yield table(rows)


_PAYLOAD = "record_id string, record_type string, page_id string, url string, refers_to string, payload binary, payload_bytes long, payload_digest string, valid boolean"


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records from their parts, which come in order."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            first, parts = r["first"], r["parts"]
            block = b"".join(p["block"] for p in parts)
            whole = first is not None and (len(parts) == 1 and first["segment"] is None or [p["segment"] for p in parts] == list(range(1, len(parts) + 1)) and r["total_length"] == len(block))
            head, _, body = block.partition(_END)
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
            first = first or dict.fromkeys(("record_type", "page_id", "url", "refers_to", "payload_digest"))
            stated = (first["payload_digest"] or "").removeprefix("sha1:")
            if first["record_type"] == "revisit":
                payload, size, digest = None, int(fields.get("content-length", 0)), stated
            else:
                try:
                    payload = unchunk(body) if fields.get("transfer-encoding") == "chunked" else body
                except ValueError:
                    payload, whole = body, False
                size, digest = len(payload), payload_digest(payload)
            out.append((r["record_id"], first["record_type"], first["page_id"], first["url"], first["refers_to"], payload, size, digest, bool(whole and digest == stated)))
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 9, kinds, strict=True)], names=[x.split()[0] for x in _PAYLOAD.split(", ")])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``, whole: record_id, record_type, page_id, url, refers_to, payload (null for revisits), payload_bytes, payload_digest, valid."""
    records = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_records, _RECORD)
    first = F.struct("record_type", "page_id", "url", "refers_to", "payload_digest", "segment")
    begins = F.coalesce(F.col("segment"), F.lit(1)) == 1
    grouped = records.groupBy("record_id").agg(F.max(F.when(begins, first)).alias("first"), F.max("total_length").alias("total_length"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    return grouped.mapInArrow(_payloads, _PAYLOAD)


def archive_round_trip(df: DataFrame, id_col="page_id", **options) -> DataFrame:
    """Write ``df`` to archives in the shared folder and read them back; ids have their type again, and a record that fails a check is an error."""
    path = f"{shared_dir(df.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_warc(df, path, id_col=id_col, **options)
    kind = df.schema[id_col].dataType
    back = read_warc(df.sparkSession, path)
    checked = F.when(F.col("valid"), F.col("page_id")).otherwise(F.raise_error(F.concat(F.lit("a record fails its checks: "), "record_id")).cast("string"))
    return back.withColumns({"page_id": checked.cast(kind), "refers_to": F.col("refers_to").cast(kind)})
