"""WARC archives: segmented, chunk-framed records written and reassembled.

Writing: every page becomes a ``response`` record, or a ``revisit`` of the
smallest page with the same payload.  An HTTP message longer than a segment is
spread over one record and ``continuation`` records.  Reading: continuation
records are grouped by their origin's identifier, ordered by segment number,
checked against the total length, and the chunked transfer framing is undone.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import columns, materialise

#: Bytes of one HTTP chunk, of a record's block at most, and of an archive's row
#: (an archive file is a few rows, so that a reader holds one file at a time).
CHUNK_BYTES = 8 << 10
SEGMENT_BYTES = 32 << 10
ROW_BYTES = 4 << 20
ROWS_PER_FILE = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def http_message(payload: bytes, chunk: int = CHUNK_BYTES) -> bytes:
    """An HTTP response that carries the payload in chunked transfer framing."""
    out = [b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"]
    for i in range(0, len(payload), chunk):
        part = payload[i:i + chunk]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unframe(message: bytes) -> bytes:
    """Payload of an HTTP message: the body, with chunked framing undone; raises
    ValueError where the framing is broken."""
    head, sep, body = message.partition(END)
    if not sep:
        raise ValueError("no end of the HTTP header")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in
              (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding") != b"chunked":
        return body
    out, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        if stop < 0:
            raise ValueError("a chunk has no size line")
        size = int(body[at:stop].split(b";")[0], 16)
        at = stop + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        out.append(body[at:at + size])
        at += size + 2


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"".join([b"WARC/1.1\r\n", head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block, END])


def header_fields(lines: list[str]) -> dict[str, str]:
    """Fields by lower-case name; spaces around values are optional, and a line that
    begins with a blank goes on with the field before.  Lines without a name are left out."""
    fields: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            fields[name] = f"{fields[name]} {line.strip()}".strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def records_of(data: bytes):
    """(fields, block, fault) of each record of an archive.  A record that is cut short
    or has no usable length is told as a fault, and reading goes on with the next
    ``WARC/`` line, so one damaged record costs no other."""
    at = 0
    while at < len(data):
        stop = data.find(END, at)
        if not data.startswith(b"WARC/", at) or stop < 0:
            more = data.find(END + b"WARC/", at)
            if data[at:].strip():
                yield {}, b"", f"no record at byte {at}"
            at = len(data) if more < 0 else more + 4
            continue
        fields = header_fields(data[at:stop].decode("utf-8", "replace").split("\r\n")[1:])
        length = fields.get("content-length", "")
        size = int(length) if length.isascii() and length.isdigit() else -1
        end = stop + 4 + size
        if size >= 0 and data[end:end + 4] == END:
            yield fields, data[stop + 4:end], None
            at = end + 4
        else:
            yield fields, b"", "a record without a length" if size < 0 else "a record is shorter than its length"
            more = data.find(END + b"WARC/", stop)
            at = len(data) if more < 0 else more + 4


def unzipped(data: bytes) -> tuple[bytes, str | None]:
    """What can be read of a gzipped archive, and why no more."""
    out, fault = [], None
    while data:
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(data) + member.flush())
        except zlib.error as e:
            return b"".join(out), f"a member can't be read: {e}"
        if not member.eof:
            fault = "a member ends early"
        data = member.unused_data.lstrip(b"\x00")
    return b"".join(out), fault


def page_records(page, url, payload: bytes, response, own: str, segment: int, chunk: int) -> list[bytes]:
    """The records of one page; ``own`` makes its identifier unique."""
    name = "null" if page is None else str(page)
    ident = f"<urn:x-page:{name}:{own}>"
    target = None if url is None else "".join(c for c in url if c.isprintable() and c != " ") or None
    common = [("WARC-Record-ID", ident), ("WARC-Date", DATE), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    if response is not None:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                 % len(payload))
        return [record([("WARC-Type", "revisit"), *common, ("WARC-Refers-To", f"<urn:x-page:{response}>"),
                        ("WARC-Profile", PROFILE), ("Content-Type", "application/http; msgtype=response")], block)]
    message = http_message(payload, chunk)
    cuts = range(0, len(message), segment)
    out = []
    for n, i in enumerate(cuts, 1):
        total = str(len(message)) if n == len(cuts) else None
        if n == 1:
            out.append(record([("WARC-Type", "response"), *common,
                               ("WARC-Segment-Number", "1" if len(cuts) > 1 else None),
                               ("Content-Type", "application/http; msgtype=response")], message[:segment]))
        else:
            out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{ident[:-1]}:{n}>"),
                               ("WARC-Date", DATE), ("WARC-Segment-Number", str(n)),
                               ("WARC-Segment-Origin-ID", ident), ("WARC-Segment-Total-Length", total)],
                              message[i:i + segment]))
    return out


def first_of_payload(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, first): the smallest page of every payload that several pages share."""
    return (pages.where(F.octet_length("payload") >= min_bytes).groupBy(F.sha1("payload").alias("digest"))
            .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"),
                 F.count(F.when(F.col("page_id").isNull(), 1)).alias("nulls"))
            .where("first < last or first is not null and nulls > 0").select("digest", "first"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, segment: int = SEGMENT_BYTES,
                   chunk: int = CHUNK_BYTES, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> None:
    """Write every row of ``pages`` as a WARC record to gzipped archives at ``path``.

    Payload: the html in UTF-8 (null: empty).  Of the rows with equal payloads of
    at least ``min_bytes`` bytes, those with the smallest page_id become response
    records and the others revisit them; a row that repeats the smallest page_id
    is a response too, null page_ids count as the largest, and if all are null all
    are responses.  Further columns are ignored; no rows, no records.
    """
    src = columns(pages, page_id=page_id, url=url, html=html).select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    first = materialise(first_of_payload(src, min_bytes), "warc-first")
    rows = (src.withColumn("digest", F.sha1("payload")).join(first, "digest", "left")
            .select("page_id", "url", "payload",
                    F.when((F.octet_length("payload") >= min_bytes)
                           & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))),
                           F.col("first")).alias("response")))

    def run(batches):
        from pyspark import TaskContext
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            cols = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                page, link, payload, response = (c[i].as_py() for c in cols)
                for r in page_records(page, link, payload, response, f"{task}.{n}", segment, chunk):
                    held.append(r)
                    size += len(r)
                n += 1
                if size >= ROW_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], names=["data"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], names=["data"])

    # A row is a run of whole records less its last line feed, which the writer adds.
    (rows.mapInArrow(run, "data binary").select(F.col("data").cast("string").alias("value"))
     .write.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)
     .option("lineSep", "\n").text(path))


PART = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("segment", T.IntegerType()),
    T.StructField("total", T.LongType()), T.StructField("block", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("found", T.StringType()),
    T.StructField("fault", T.StringType()),
])


def finish(kind: str, message: bytes) -> tuple[int | None, str | None, str | None, bytes | None]:
    """Payload length, digest, fault and payload of a whole HTTP message."""
    if kind == "revisit":
        fields = dict(line.split(b": ", 1) for line in message.split(b"\r\n")[1:] if b": " in line)
        return int(fields.get(b"Content-Length", b"0")), None, None, None
    try:
        payload = unframe(message)
    except ValueError as e:
        return None, None, str(e), None
    return len(payload), base32_sha1(payload), None, payload


ARROW_PART = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("digest", pa.string()),
    ("refers_to", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()),
    ("payload_bytes", pa.int64()), ("found", pa.string()), ("fault", pa.string())])


def read_records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record: whole records are finished on the spot (their payload
    is kept as ``block`` if asked for), segments keep their blocks; ``record_id``
    of a segment is its origin's.  Header names may be in any case, with or without a
    space after the colon, values may be folded; records of other kinds than responses
    and revisits come without a payload.  What can't be read is a row with ``fault``
    (without an id if there is none); the records around it stay."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def row(f: dict, block: bytes, fault: str | None) -> dict:
        kind, segment = f.get("warc-type"), f.get("warc-segment-number")
        number = int(segment) if segment and segment.isascii() and segment.isdigit() else None
        total = f.get("warc-segment-total-length")
        size = found = None
        if fault is None and segment is not None and number is None:
            fault = "a segment without a number"
        if fault is None and segment is None and kind in ("response", "revisit"):
            size, found, fault, block = finish(kind, block)
        return {"record_id": f.get("warc-segment-origin-id") or f.get("warc-record-id"), "record_type": kind,
                "target_uri": f.get("warc-target-uri"), "refers_to": f.get("warc-refers-to"),
                "digest": (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
                "segment": number, "total": int(total) if total and total.isascii() and total.isdigit() else None,
                "block": block if fault is None and (number or payload) else None,
                "payload_bytes": size, "found": found, "fault": fault}

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data, broken = unzipped(batch.column(0)[i].as_py())
                rows = [row(*r) for r in records_of(data)]
                if broken:
                    rows.append(row({}, b"", broken))
                yield pa.RecordBatch.from_pylist(rows, schema=ARROW_PART)

    return files.mapInArrow(run, PART)


def reassemble(records: DataFrame, payload: bool = False) -> DataFrame:
    """One row per origin record, its segments joined in order.

    Returns record_id, record_type, target_uri, digest (as the record states
    it), refers_to, payload_bytes, found (digest of the payload as read; null for
    revisits) and fault: null, or why the record can't be trusted (segments
    missing or repeated, total length wrong, framing broken, digest differs).
    With ``payload`` the payload itself follows, null for revisits and faults
    (``records`` must then have been read with it).  A group is the segments of
    one record, as large as one payload; no records, no rows.
    """
    head = ["record_id", "record_type", "target_uri", "digest", "refers_to"]
    tail = ["payload_bytes", "found", "fault"]
    grouped = records.groupBy("record_id").agg(
        *(F.max(F.when(F.col("record_type") != "continuation", F.col(c))).alias(c) for c in head[1:]),
        *(F.max(c).alias(c) for c in tail), F.max("total").alias("total"), F.count("segment").alias("segments"),
        F.sort_array(F.collect_list(F.when(F.col("block").isNotNull(), F.struct("segment", "block")))).alias("parts"))
    out = T.StructType([f for f in PART if f.name in head + tail]
                       + ([T.StructField("payload", T.BinaryType())] if payload else []))
    arrow = pa.schema([ARROW_PART.field(c) for c in head + tail] + ([("payload", pa.binary())] if payload else []))

    def joined(r: dict) -> dict:
        blocks = [p["block"] for p in r["parts"]]
        if not r["segments"]:
            return {**r, "payload": blocks[0] if blocks else None}
        if r["record_type"] is None or [p["segment"] for p in r["parts"]] != list(range(1, len(blocks) + 1)):
            return {**r, "fault": "segments are missing or repeated"}
        message = b"".join(blocks)
        if r["total"] != len(message):
            return {**r, "fault": "the segments differ from the total length"}
        size, found, fault, data = finish(r["record_type"], message)
        return {**r, "payload_bytes": size, "found": found, "fault": fault, "payload": data}

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                rows = [joined(r) for r in batch.slice(i, 64).to_pylist()]
                yield pa.RecordBatch.from_pylist([{k: r.get(k) for k in arrow.names} for r in rows], schema=arrow)

    differs = F.col("fault").isNull() & (F.col("found") != F.col("digest"))
    return grouped.mapInArrow(run, out).withColumn(
        "fault", F.when(differs, "the payload's digest differs").otherwise(F.col("fault")))


def page_of(ident: Column) -> Column:
    """Page id in a record identifier; null for a page without one."""
    part = F.regexp_extract(ident, r"^<urn:x-page:(-?\d+)", 1)
    return F.when(part != "", part).cast("bigint")
