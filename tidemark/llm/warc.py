"""WARC archives: records written in segments with chunked bodies, read back and reassembled.

Writing: a body goes out as an HTTP response in chunked transfer coding; a block longer than
``segment_bytes`` is cut into a first record and continuation records. Bodies equal in SHA-1 are
written once: the row with the smallest id is the response, others become revisit records.

The files are gzip text files whose rows end with the two line feeds that end a record, so Spark's
own writer, with its commit protocol, makes them on any file system; and a gzip file is not split,
so its rows reach one task in order. Reading goes through them row by row and holds one record.

Reassembly deals segments by the identifier of their first record, sorts them by number within
partitions, and reads each record as a stream: none may be missing, the total length must be the
stated one, and the chunked framing is decoded piece by piece, so that for sizes and digests no
record is held whole. Records in one piece are decoded where they are parsed and skip that shuffle.

Defined cases: a null body is written as an empty one. A null id is left out of its record and read
back as null; of equal bodies a row without an id comes after those with one. Rows of equal id are
all kept: they are told apart by their record identifiers; of equal bodies and equal ids, one is the
response. Control characters in addresses are written as %XX. Repeated copies of one segment count
once. A record that lacks segments, has a wrong length or broken framing is given back with
``complete`` false and no payload. An empty table writes no record. Only named columns are read."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha1
from uuid import UUID

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.cluster import prepare, written

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
ROWS_PER_FILE = 200_000
END = b"\r\n\r\n"
CONTROL = re.compile(r"[\x00-\x1f\x7f]")
DATE = "2026-01-05T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_digest(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``body`` in chunked transfer coding."""
    out = []
    for at in range(0, len(body), size):
        piece = body[at : at + size]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


class Chunks:
    """The body of a chunked transfer coding that comes in pieces."""

    def __init__(self):
        self.held, self.left, self.ended = b"", 0, False  # left: of a chunk and the line feed behind it

    def feed(self, data: bytes) -> Iterator[bytes]:
        """Parts of the body; ValueError if the framing is broken."""
        data, at = self.held + data, 0
        while not self.ended:
            if self.left > 2:
                part = data[at : at + self.left - 2]
                if not part:
                    break
                yield part
                self.left, at = self.left - len(part), at + len(part)
            elif self.left:
                if len(data) - at < 2:
                    break
                if data[at : at + 2] != b"\r\n":
                    raise ValueError("a chunk does not end where it should")
                self.left, at = 0, at + 2
            else:
                end = data.find(b"\r\n", at)
                if end < 0:
                    break
                size = int(data[at:end].split(b";")[0], 16)
                if size < 0:
                    raise ValueError("a chunk of negative size")
                self.left, at, self.ended = size + 2, end + 2, size == 0
        self.held = data[at:]


def unchunked(data: bytes) -> bytes:
    """The body of ``data`` in chunked transfer coding; ValueError if the framing is broken."""
    chunks = Chunks()
    body = b"".join(chunks.feed(data))
    if not chunks.ended:
        raise ValueError("the last chunk is missing")
    return body


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    """A record without the two line feeds at its end."""
    plain = {k: CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", v) for k, v in fields.items() if v is not None}
    head = "".join(f"{k}: {v}\r\n" for k, v in plain.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def record_id(text: str, part: int = 1) -> str:
    """A fixed identifier for each key and segment."""
    raw = bytearray(sha1(f"{part}|{text}".encode()).digest()[:16])
    raw[6], raw[8] = raw[6] & 0x0F | 0x50, raw[8] & 0x3F | 0x80
    return f"<urn:uuid:{UUID(bytes=bytes(raw))}>"


def records(key: str, row_id: str | None, url: str, body: bytes, digest: str, first: str | None,
            first_key: str | None, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: its response in segments, or a revisit of ``first``."""
    fields = {
        "WARC-Type": "response", "WARC-Record-ID": record_id(key), "WARC-Date": DATE,
        "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Row-ID": row_id, "X-Payload-Length": str(len(body)),
        "Content-Type": "application/http;msgtype=response",
    }
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first_key is not None:
        yield record(
            fields | {"WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE,
                      "WARC-Refers-To": record_id(first_key), "X-Refers-To-Row": first},
            head + b"\r\n",
        )
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(body)
    if len(block) <= segment_bytes:
        yield record(fields, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for number, at in enumerate(cuts, 1):
        own = {"WARC-Segment-Number": str(number)}
        if number > 1:
            own |= {"WARC-Type": "continuation", "WARC-Record-ID": record_id(key, number),
                    "WARC-Date": DATE, "WARC-Segment-Origin-ID": record_id(key)}
        if number == len(cuts):
            own["WARC-Segment-Total-Length"] = str(len(block))
        yield record(fields | own if number == 1 else own, block[at : at + segment_bytes])


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
          body_col: str = "html", min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write a record (or its segments) per row of ``pages`` below ``path``.

    Bodies shorter than ``min_bytes`` are never revisits. The first row of each digest is found on
    digests and ids alone; bodies are shuffled once, in a join that adaptive execution can split
    where one digest has many rows."""
    prepare(pages.sparkSession)
    body = F.coalesce(pages[body_col].cast("binary"), F.lit(b""))
    rows = pages.select(
        pages[id_col].alias("row_id"), pages[url_col].cast("string").alias("url"), body.alias("body"),
        F.sha1(body).alias("digest"),
    )
    # Rows of equal id and body are alike but for their url, and the smallest of them is first.
    order = F.struct(F.col("row_id").isNull().alias("no_id"), "row_id", "url")
    same = F.length("body") >= min_bytes
    firsts = (
        rows.where(same).groupBy("digest").agg(F.min(order).alias("first"))
        .select(F.col("digest").alias("d"), "first")
    )
    joined = rows.join(firsts, (rows.digest == firsts.d) & same, "left").select(
        "row_id", "url", "digest", "first",
        (order.eqNullSafe(F.col("first")) | F.col("first").isNull()).alias("response"), "body",
    )

    def work(batches):
        for batch in batches:
            out = []
            for row_id, url, digest, first, response, body in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                key, first_key = f"{row_id}|{url}|{digest}", None
                if not response:
                    first_key = f"{first['row_id']}|{first['url']}|{digest}"
                name = None if row_id is None else str(row_id)
                seen = None if first is None or first["row_id"] is None else str(first["row_id"])
                out += records(key, name, url or "", body, base32_digest(digest), seen, first_key,
                               segment_bytes)
                if sum(map(len, out[-64:])) > 8 << 20 or len(out) > 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    made = joined.mapInArrow(work, "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.text(
        path, compression="gzip", lineSep="\r\n\r\n"
    )


FIELDS = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("url", pa.string()), ("row_id", pa.string()),
    ("digest", pa.string()), ("refers_to", pa.string()), ("segment", pa.int32()),
    ("origin", pa.string()), ("total", pa.int64()), ("block", pa.binary()), ("complete", pa.bool_()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
FIELDS_DDL = (
    "record_id string, type string, url string, row_id string, digest string, refers_to string,"
    " segment int, origin string, total bigint, block binary, complete boolean,"
    " payload_bytes bigint, payload_digest string, payload binary"
)
HEAD = ("record_id", "type", "url", "row_id", "digest", "refers_to")
FIGURES = ("complete", "payload_bytes", "payload_digest")


class Parser:
    """Records out of the lines of one file, in order; a line has lost the line feed at its end."""

    def __init__(self):
        self.fields: dict[str, str] | None = None
        self.left = -1  # bytes of the block still to come; -1 while in the head or between records
        self.block: list[bytes] = []

    def line(self, raw: bytes) -> dict | None:
        if self.left >= 0:
            piece = raw + b"\r\n"
            if len(piece) < self.left:
                self.block.append(piece)
                self.left -= len(piece)
                return None
            self.block.append(piece[: self.left])
            return self.finished()
        if self.fields is None:
            if raw.startswith(b"WARC/"):
                self.fields = {}
            return None
        if raw:
            name, _, value = raw.decode("utf-8", "replace").partition(":")
            self.fields[name.strip().lower()] = value.strip()
            return None
        self.left, self.block = int(self.fields.get("content-length", 0)), []
        return self.finished() if self.left == 0 else None

    def finished(self) -> dict:
        f, block = self.fields, b"".join(self.block)
        self.fields, self.left, self.block = None, -1, []
        number = f.get("warc-segment-number")
        return {
            "record_id": f.get("warc-record-id"), "type": f.get("warc-type"),
            "url": f.get("warc-target-uri"), "row_id": f.get("x-row-id"),
            "digest": f.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_to": f.get("x-refers-to-row"), "segment": int(number) if number else None,
            "origin": f.get("warc-segment-origin-id") or (number and f.get("warc-record-id")),
            "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
            "block": block,
        }


class Body:
    """The payload of a record that comes in pieces: an HTTP head, then a body, chunked or not."""

    def __init__(self, kind: str | None, keep: bool):
        self.kind, self.digest, self.size, self.broken = kind, sha1(), 0, False
        self.kept: list[bytes] | None = [] if keep else None
        self.head: bytes | None = b""  # None when it has been read
        self.chunks: Chunks | None = None

    def feed(self, data: bytes) -> None:
        if self.kind == "revisit" or self.broken:
            return
        if self.head is not None:
            head, split, data = (self.head + data).partition(END)
            if not split:
                self.head = head
                return
            self.chunks = Chunks() if b"transfer-encoding: chunked" in head.lower() else None
            self.head = None
        try:
            for part in self.chunks.feed(data) if self.chunks else (data,):
                self.size += len(part)
                self.digest.update(part)
                if self.kept is not None:
                    self.kept.append(part)
        except ValueError:
            self.broken = True

    def figures(self, complete: bool) -> dict:
        """``complete`` of the record, and size, digest and bytes of its payload if it is."""
        if self.kind != "revisit":
            open_end = self.head is not None or (self.chunks is not None and not self.chunks.ended)
            complete = complete and not self.broken and not open_end
        if self.kind == "revisit" or not complete:
            return {"complete": complete, "payload_bytes": None, "payload_digest": None, "payload": None}
        return {
            "complete": True, "payload_bytes": self.size,
            "payload_digest": base64.b32encode(self.digest.digest()).decode(),
            "payload": None if self.kept is None else b"".join(self.kept),
        }


def payload(block: bytes) -> bytes | None:
    """The body of an HTTP response; None if it cannot be decoded."""
    body = Body(None, True)
    body.feed(block)
    return body.figures(True)["payload"]


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row["block"] or b"") + len(row["payload"] or b"")
        if size > 8 << 20 or len(out) > 2048:
            yield pa.RecordBatch.from_pylist(out, schema=FIELDS)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=FIELDS)


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records of the gzip archives below ``path``: segments with their ``block``, and records in
    one piece with the figures of their payload instead, and the ``payload`` itself if asked for."""
    prepare(spark)
    lines = spark.read.text(path, lineSep="\r\n").select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file")
    )

    def work(batches):
        yield from _batches(parsed(batches))

    def parsed(batches):
        parser, file = Parser(), None
        for batch in batches:
            for raw, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != file:
                    parser, file = Parser(), name
                found = parser.line(raw)
                if not found:
                    continue
                body = Body(found["type"], payloads)
                if found["segment"] is None:
                    body.feed(found["block"])
                    found["block"] = None
                yield found | body.figures(found["segment"] is None)

    return lines.mapInArrow(work, FIELDS_DDL)


def reassembled(found: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record; the figures of those in segments are found by reading them in order."""
    single, parts = found.where("segment is null"), found.where("segment is not null")
    dealt = parts.repartition("origin").sortWithinPartitions("origin", "segment", "record_id", "block")

    def work(batches):
        yield from _batches(joined(batches))

    def joined(batches):
        origin, head, body, last, length, total = None, None, None, 0, 0, None

        def record():
            whole = total is not None and length == total
            return head | body.figures(whole and last > 0) | {"record_id": origin, "segment": None, "block": None}

        for batch in batches:
            # A few segments at a time become Python objects.
            for first in range(0, batch.num_rows, 64):
                for row in batch.slice(first, 64).to_pylist():
                    if row["origin"] != origin:
                        if origin is not None:
                            yield record()
                        origin, head, last, length, total = row["origin"], row, 0, 0, None
                        body = Body(row["type"], payloads)
                    if row["segment"] == last and last > 0:
                        continue  # a copy
                    # A gap spoils the record: its length cannot be right any more.
                    last = row["segment"] if row["segment"] == last + 1 and last >= 0 else -1
                    if last > 0:
                        body.feed(row["block"])
                        length += len(row["block"])
                        total = row["total"] if row["total"] is not None else total
        if origin is not None:
            yield record()

    return single.unionByName(dealt.mapInArrow(work, FIELDS_DDL))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Per record: record_id, type, url, row_id, digest (as stated), refers_to, complete, payload
    (null for revisits and what is not complete), payload_bytes, payload_digest (as found)."""
    return reassembled(read_records(spark, path, payloads=True), payloads=True).select(*HEAD, *FIGURES, "payload")


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_payloads``, without the payloads. The archives are parsed once: what is written on
    the way are figures, and the blocks of segments only."""
    found = written(read_records(spark, path), "warc-records")
    return written(reassembled(found).select(*HEAD, *FIGURES), "warc-figures")


def resolved(found: DataFrame) -> DataFrame:
    """Revisits with the size and digest of the payload they refer to, read from its record.

    Only figures are joined, not payloads; a digest that many revisits share is split by adaptive
    execution, as each digest has one figure."""
    figures = found.select(*HEAD, *FIGURES)
    known = (
        figures.where("type = 'response' and complete").groupBy("payload_digest")
        .agg(F.first("payload_bytes").alias("n"))
        .select(F.col("payload_digest").alias("d"), "n")
    )
    revisits = figures.where("type = 'revisit'")
    got = revisits.join(known, revisits.digest == known.d, "left").select(
        *(c for c in figures.columns if c not in ("payload_bytes", "payload_digest")),
        F.col("n").alias("payload_bytes"), F.col("d").alias("payload_digest"),
    )
    return figures.where("type <> 'revisit'").unionByName(got)


