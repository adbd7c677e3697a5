"""WARC archives written and read in parallel, with an index first.

Writing: each task writes one archive of gzip members, a record each, into the shared folder and
returns an index row per record: file, offset, length, URL and payload digest. A payload that stands
in several rows is stored once, as the response of the row with the largest id; the others are revisit
records that name it. Which rows are revisits is decided in Spark from digests; the payloads are not
shuffled for it unless the repeated digests are too many to broadcast. An attempt that fails leaves a
file that no index row names.

Reading: the index rows wanted are sorted by file and offset and cut into stretches of a few megabytes;
neighbouring records become one byte-range read, so a sparse selection reads little and a full one
reads each file once, from front to back, in parallel.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.llm.common import scratch_path, small_side, written
from tte.llm.files import store, unique_name

#: Bytes that one stretch of records spans, and gaps that are read rather than skipped.
STRETCH = 4 << 20
GAP = 64 << 10
#: Archive bytes that one reading task takes on average.
READ_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"  # records carry a fixed date, so that reruns write equal archives

INDEX = "path string, offset bigint, length bigint, page_id bigint, url string, digest string, record_type string"
RECORDS = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One gzip member with a response or revisit record. A revisit has the HTTP header of the full
    payload, whose length it states, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        head.append(("Page-ID", page_id))
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _id(refers_to)), ("Refers-To-Page-ID", refers_to)]
    head += [("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("Content-Type", "application/http;msgtype=response"),
             ("Content-Length", len(block))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """The record of one gzip member, in the columns of ``RECORDS``; a response is checked against its
    digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != full or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("Page-ID"), "url": fields.get("WARC-Target-URI"), "payload": payload if kind == "response" else None,
            "payload_bytes": full, "payload_digest": digest, "record_type": kind, "refers_to": number("Refers-To-Page-ID")}


def _write_archives(folder: str):
    def run(batches):
        out = path = None
        at = 0
        for batch in batches:
            col = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in batch.schema.names}
            rows = []
            for page, url, payload, refers in zip(col["page_id"], col["url"], col["payload"], col["refers_to"], strict=True):
                if out is None:
                    path = unique_name(folder, "archive") + ".warc.gz"
                    system, local = store(path)
                    system.create_dir(local.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(local, compression=None)
                member = record_bytes(page, url, payload, refers, refers is not None)
                out.write(member)
                rows.append({"path": path, "offset": at, "length": len(member), "page_id": page, "url": url,
                             "digest": digest_of(payload), "record_type": "response" if refers is None else "revisit"})
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
        if out is not None:
            out.close()
    return run


_INDEX = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())])
_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def write_warc(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record per row and return the index (``INDEX``), itself written in the shared folder.

    Null payloads are empty, null URLs and ids have no header. Equal payloads share one response, that
    of the largest id; rows that repeat that id are responses too, and so is every row of a payload
    that only rows without an id have. An empty table writes no archive."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    own = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"),
                       F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload")).withColumn("same", F.unhex(F.sha2("payload", 256)))
    repeated = written(own.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("top"))
                       .where("n > 1 and top is not null").select("same", "top"), "warc-repeated")
    rows = (own.join(small_side(repeated), "same", "left")
            .select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to")))
    return written(rows.mapInArrow(_write_archives(folder), INDEX), "warc-index")


def _read_ranges(with_payload: bool):
    def read(rows):
        """Byte ranges of neighbouring records, each read once."""
        held, system, handle = [], None, None
        opened = None

        def load(group):
            start = group[0][1]
            handle.seek(start)
            data = handle.read(group[-1][1] + group[-1][2] - start)
            for _, offset, length in group:
                yield parse_record(data[offset - start: offset - start + length])

        for row in rows:
            path, offset, _ = row
            if held and (path != opened or offset > held[-1][1] + held[-1][2] + GAP or offset - held[0][1] > STRETCH):
                yield from load(held)
                held = []
            if path != opened:
                if handle is not None:
                    handle.close()
                system, local = store(path)
                handle, opened = system.open_input_file(local), path
            held.append(row)
        if held:
            yield from load(held)
        if handle is not None:
            handle.close()

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("path", "offset", "length")), strict=True)

        out, size = [], 0
        for record in read(rows()):
            size += len(record["payload"] or b"") + 200
            if not with_payload:
                record["payload"] = None
            out.append(record)
            if len(out) >= 4096 or size >= STRETCH:
                yield pa.RecordBatch.from_pylist(out, schema=_RECORDS)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RECORDS)
    return run


def read_warc(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows (all, or a selection), in the columns of ``RECORDS``.

    Revisits have a null payload; their size and digest are those of the payload they refer to."""
    stretch = F.floor(F.col("offset") / STRETCH)
    # by number: the index rows are small, so sized by them all archives would fall to a few tasks
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 1) // READ_BYTES)
    return (index.select("path", "offset", "length").repartition(int(tasks), "path", stretch).sortWithinPartitions("path", "offset")
            .mapInArrow(_read_ranges(with_payload), RECORDS))
