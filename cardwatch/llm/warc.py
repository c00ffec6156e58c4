"""WARC archives: segmented records with chunked payloads, written by Spark and put together again."""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import fresh_path, materialize

#: Bytes of HTTP block in one record, of one transfer chunk, and about the bytes of one archive file.
SEGMENT_BYTES, CHUNK_BYTES, FILE_BYTES = 8 * 1024, 4 * 1024, 16 * 2**20
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD = (
    "record_id string, kind string, page_id long, refers string, segment int, total long, origin string, "
    "declared string, payload_bytes long, digest string, block binary"
)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a body in chunked transfer framing; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = end + 2 + size
        parts.append(body[end + 2:at])
        if len(parts[-1]) < size or body[at:at + 2] != b"\r\n":
            raise ValueError("chunk does not have its stated length")
        at += 2


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(END)
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(fields: dict, block: bytes) -> bytes:
    """One record without the two line ends that close it; the text writer adds those."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def records_of(row: dict, segment_bytes: int) -> Iterator[bytes]:
    url = "".join(c for c in row["url"] or "" if c >= " ")
    base = {
        "WARC-Type": row["kind"], "WARC-Record-ID": row["record_id"], "WARC-Target-URI": url or None,
        "WARC-Payload-Digest": "sha256:" + row["digest"].hex(), "WARC-Page-ID": row["page_id"],
    }
    if row["kind"] == "revisit":
        base |= {"WARC-Refers-To": row["refers"],
                 "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
        yield record(base, HTTP)
        return
    block = HTTP + chunked(row["payload"])
    if len(block) <= segment_bytes:
        yield record(base, block)
        return
    starts = range(0, len(block), segment_bytes)
    for n, at in enumerate(starts, 1):
        part = block[at:at + segment_bytes]
        if n == 1:
            yield record(base | {"WARC-Segment-Number": 1}, part)
            continue
        yield record({
            "WARC-Type": "continuation", "WARC-Record-ID": f"{row['record_id'][:-1]}-{n}>",
            "WARC-Segment-Origin-ID": row["record_id"], "WARC-Segment-Number": n,
            "WARC-Segment-Total-Length": len(block) if n == len(starts) else None,
        }, part)


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("none")), F.hex(digest)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 100, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write one record per page row, in gzipped archives below ``path``.

    Payload: the html in UTF-8, framed in chunks. A response longer than ``segment_bytes`` goes on
    in continuation records. Of pages with equal payloads of at least ``least_bytes`` bytes the one
    with the smallest page_id is a response, the others are revisits that refer to it.
    """
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    base = base.withColumns({"n": F.octet_length("payload"), "digest": F.unhex(F.sha2("payload", 256))})
    firsts = (
        base.filter(F.col("n") >= least_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    )
    rows, size = base.agg(F.count("*"), F.sum("n")).first()
    per_file = max(1, int(FILE_BYTES * (rows or 1) / ((size or 0) + 400 * (rows or 1))))
    repeat = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    plan = base.join(firsts, "digest", "left").select(
        "page_id", "url", "digest", F.when(~F.coalesce(repeat, F.lit(False)), F.col("payload")).alias("payload"),
        F.when(repeat, "revisit").otherwise("response").alias("kind"),
        _record_id(F.col("page_id"), F.col("digest")).alias("record_id"),
        F.when(repeat, _record_id(F.col("first"), F.col("digest"))).alias("refers"))

    def write(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for data in records_of(row, segment_bytes):
                    yield pa.record_batch([pa.array([data], pa.binary())], ["value"])

    lines = plan.mapInArrow(write, "value binary").select(F.col("value").cast("string").alias("value"))
    (lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


class _Gunzip(io.RawIOBase):
    """Bytes of a gzip file of any number of members, a piece at a time."""

    def __init__(self, data: bytes):
        self.rest, self.z = data, zlib.decompressobj(31)

    def readable(self):
        return True

    def readinto(self, out):
        while True:
            piece = self.z.decompress(self.rest, len(out))
            self.rest = self.z.unconsumed_tail
            if piece:
                out[:len(piece)] = piece
                return len(piece)
            if self.z.eof and self.z.unused_data:
                self.rest, self.z = self.z.unused_data, zlib.decompressobj(31)
            elif not self.rest:
                return 0


def parse(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Records of one archive: fields by lower-case name, and the block."""
    if data[:2] == b"\x1f\x8b":
        source = io.BufferedReader(_Gunzip(data), 1 << 18)
    else:
        source = io.BytesIO(data)
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins here: {line[:40]!r}")
        fields = {}
        while (line := source.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = source.read(size)
        if len(block) != size:
            raise ValueError("record is shorter than its stated length")
        yield fields, block


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _rows(batches):
    for batch in batches:
        for content in batch.column("content"):
            out = []
            for f, block in parse(content.as_py()):
                kind, segment = f["warc-type"], _number(f.get("warc-segment-number"))
                row = {
                    "record_id": f["warc-record-id"], "kind": kind, "page_id": _number(f.get("warc-page-id")),
                    "refers": f.get("warc-refers-to"), "segment": segment,
                    "total": _number(f.get("warc-segment-total-length")), "origin": f.get("warc-segment-origin-id"),
                    "declared": f.get("warc-payload-digest", "").removeprefix("sha256:"),
                    "payload_bytes": None, "digest": None, "block": None,
                }
                if segment is not None:
                    row["block"], row["origin"] = block, row["origin"] or row["record_id"]
                elif kind == "response":
                    row["payload_bytes"], row["digest"] = measured(block, row["declared"])
                out.append(row)
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, SCHEMA)
                    out = []
            yield pa.RecordBatch.from_pylist(out, SCHEMA)


SCHEMA = pa.schema([
    ("record_id", pa.string()), ("kind", pa.string()), ("page_id", pa.int64()), ("refers", pa.string()),
    ("segment", pa.int32()), ("total", pa.int64()), ("origin", pa.string()), ("declared", pa.string()),
    ("payload_bytes", pa.int64()), ("digest", pa.string()), ("block", pa.binary()),
])


def measured(block: bytes, declared: str) -> tuple[int, str]:
    payload = payload_of(block)
    digest = hashlib.sha256(payload).hexdigest()
    if declared and digest != declared:
        raise ValueError("payload does not have its stated digest")
    return len(payload), digest


def reassembled(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """Block of a record from its segments (number, total length, bytes); equal repeats count once."""
    parts = {n: (total, block) for n, total, block in segments}
    if sorted(parts) != list(range(1, len(parts) + 1)):
        raise ValueError("a segment is missing")
    block, total = b"".join(parts[n][1] for n in sorted(parts)), parts[len(parts)][0]
    if total != len(block):
        raise ValueError("segments do not have their stated total length")
    return block


def _join_segments(batches):
    for batch in batches:
        for row in batch.to_pylist():
            block = reassembled([(s["segment"], s["total"], s["block"]) for s in row["parts"]])
            n, digest = measured(block, row["declared"])
            one = {"record_id": row["origin"], "page_id": row["page_id"], "payload_bytes": n, "digest": digest}
            yield pa.RecordBatch.from_pylist([one] * row["copies"], JOINED)


JOINED = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.string())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Continuation records are grouped by the identifier of the record they continue, ordered by
    segment number, held against the total length and decoded. Segments of a record may lie in
    different archives; only such records are shuffled. Revisits take size and digest from the
    response they refer to. A missing segment, a wrong length or a wrong digest raises ValueError.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = materialize(files.mapInArrow(_rows, RECORD), "warc-records")
    whole = parsed.filter("kind = 'response' and segment is null").select("record_id", "page_id", "payload_bytes", "digest")
    first = F.col("segment") == 1
    parts = (
        parsed.filter("segment is not null").groupBy("origin").agg(
            F.collect_set(F.struct("segment", "total", "block")).alias("parts"),
            F.max(F.when(first, F.col("page_id"))).alias("page_id"), F.max("declared").alias("declared"),
            F.count(F.when(first, 1)).alias("copies"))
    )
    joined = parts.mapInArrow(_join_segments, "record_id string, page_id long, payload_bytes long, digest string")
    responses = materialize(whole.union(joined), "warc-responses")
    known = responses.groupBy("record_id").agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("payload_bytes"),
        F.first("digest").alias("payload_digest"))
    revisits = (
        parsed.filter("kind = 'revisit'").select("page_id", F.col("refers").alias("record_id"))
        .join(known, "record_id", "left")
        .select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    )
    return responses.select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to")).union(revisits)


def archive_round_trip(pages: DataFrame, least_bytes: int = 100, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the pages as archives in the shared folder and read those back; one row per page row.

    NULL html: an empty payload. Short payloads (under ``least_bytes``) are always responses. Rows
    that share the smallest page_id of a payload are all responses. NULL page_id is kept; it is
    never the one referred to unless no other has the payload, and then all are responses. An
    empty table gives an empty result. Other columns are not read.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, least_bytes, segment_bytes)
    return read_archives(spark, path)
