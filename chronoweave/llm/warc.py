"""WARC archives: written in segments with chunked transfer framing, read back and put together.

A page is a response record, or a revisit record of the first page with the same payload. A block
longer than a segment goes on in continuation records, which name the first by its identifier,
count from 2, and state the total length in the last. A response's payload is sent in chunks.

Archives are plain WARC files, gzipped, of a bounded number of records of bounded size, written
and read with Spark's own sources only, so they can lie in any store that Spark reaches. Reading
groups the segments of a record by the identifier of their origin, orders them by number, checks
number, total length and digest, and decodes the chunks. Whole records are decoded where they
are read, so only segments move.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.common import MOST_BROADCAST_KEYS, annotate, added, quoted

#: Bytes of a block in one record, bytes of a chunk, records in an archive. An archive is thus no
#: larger than SEGMENT_BYTES * ARCHIVE_RECORDS and its headers.
SEGMENT_BYTES, CHUNK_BYTES, ARCHIVE_RECORDS = 16 << 10, 4 << 10, 4096

#: Bytes that are unpacked at a time, so that what precedes damage is kept; segments beyond this number are one.
_PIECE, _MOST_SEGMENTS = 1 << 12, (1 << 31) - 1
_VERSION, _END = b"WARC/1.1\r\n", b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f<>]")
#: A field of our own on segments: rows with equal id and payload share identifiers, but not this.
_COPY = "X-Segments-Copy"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def identifier(id: str | None, digest: str) -> str:
    """The identifier of a page's record: one for each id and payload."""
    return f"<urn:page:{'' if id is None else id}:{digest}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in the framing of chunked transfer."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0 or end + 2 + size > len(body):
            return None
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            return None
        at = end + 4 + size


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record without the two line ends that close it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return _VERSION + head + b"Content-Length: %d\r\n\r\n" % len(block) + block


def page_records(id: str | None, url: str | None, payload: bytes, first: str | None, date: str, segment_bytes: int) -> Iterator[bytes]:
    """The records of a page; `first` is the identifier that it revisits, if it does."""
    digest = base32_sha1(payload)
    name = identifier(id, digest)
    target = [("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))] if url else []
    common = [("WARC-Date", date), *target, ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if first is not None:
        revisit = [("WARC-Type", "revisit"), ("WARC-Record-ID", name), ("WARC-Refers-To", first), ("WARC-Profile", _PROFILE.decode())]
        yield record([*revisit, *common], _HTTP)
        return
    block = _HTTP + chunked(payload)
    head = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common]
    if len(block) <= segment_bytes:
        yield record(head, block)
        return
    # Rows alike have one identifier; this field tells whose segments are whose.
    copy = (_COPY, uuid.uuid4().hex)
    yield record([*head, ("WARC-Segment-Number", "1"), copy], block[:segment_bytes])
    for n, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", name[:-1] + f":{n}>"), ("WARC-Date", date), *target]
        own += [("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(n)), copy]
        if at + segment_bytes >= len(block):
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record(own, block[at : at + segment_bytes])


def write_archives(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    archive_records: int = ARCHIVE_RECORDS,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Writes a record for each row of pages to archives in `folder`.

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads of at least
    `least_bytes` those with the smallest id are responses and all others revisit it; rows that
    repeat that id with that payload are responses alike, and a row without id revisits if any
    has one. Smaller payloads are responses. An empty table writes no record.
    """
    own = pages.select(
        pages[quoted(id)].alias("id"),
        pages[quoted(url)].cast("string").alias("url"),
        F.coalesce(pages[quoted(html)].cast("binary"), F.lit(b"")).alias("payload"),
    )
    own = own.withColumn("sum", F.sha2("payload", 256))
    large = own.where(F.octet_length("payload") >= least_bytes)
    groups = large.groupBy("sum").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    repeated = groups.where("n > 1 and first is not null").select(F.col("sum").alias("same"), "first")
    n_repeated = repeated.count()
    if n_repeated:
        repeated = F.broadcast(repeated) if n_repeated <= MOST_BROADCAST_KEYS else repeated
        own = own.join(repeated, own.sum == repeated.same, "left")
    else:
        own = own.withColumn("first", F.lit(None).cast(own.schema["id"].dataType))
    own = own.select(
        F.col("id").cast("string"),
        "url",
        "payload",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("first"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready, size = [], 0
            for row in zip(*batch.columns):
                name, address, payload, first = (v.as_py() for v in row)
                refers = None if first is None else identifier(first, base32_sha1(payload))
                for r in page_records(name, address, payload, refers, date, segment_bytes):
                    ready.append(r)
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], names=["record"])
                    ready, size = [], 0
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], names=["record"])

    records = own.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    options = {"lineSep": _END.decode(), "compression": "gzip", "maxRecordsPerFile": str(archive_records)}
    records.write.options(**options).text(folder)


def unpacked(data: bytes) -> bytes:
    """The content of an archive, gzip members one after the other; of a damaged one what can be read."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts, rest = [], memoryview(data)
    while rest:
        member = zlib.decompressobj(wbits=31)
        try:
            while rest and not member.eof:
                piece, rest = rest[:_PIECE], rest[_PIECE:]
                parts.append(member.decompress(piece))
        except zlib.error:
            break
        rest = memoryview(data)[len(data) - len(rest) - len(member.unused_data) :]
    return b"".join(parts)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Header fields in lower case and block of each record of an archive.

    The block of a record whose length is no number, or more than what is left, is None; reading goes on at
    the next version line, as it does after anything that is no record.
    """
    at = data.find(_VERSION)
    while at >= 0:
        end = data.find(_END, at)
        if end < 0:
            return
        lines = data[at + len(_VERSION) : end].decode("utf-8", "replace").split("\r\n")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = head.get("content-length", "")
        start = end + len(_END)
        stop = start + int(length) if length.isdecimal() else start
        if length.isdecimal() and stop <= len(data):
            yield head, data[start:stop]
            at = data.find(_VERSION, stop)
        else:
            yield head, None
            at = data.find(_VERSION, start)


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response: what follows its header, freed of chunked framing."""
    head, found, body = block.partition(_END)
    if not found:
        return None
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:.*chunked", head) else body


def together(parts: list[dict]) -> bytes | None:
    """The block of a record's segments, ordered by number; None if one lacks or lengths differ."""
    parts = sorted(parts, key=lambda p: (p["number"], p["block"]))
    copies = sum(p["number"] == 1 for p in parts)
    parts = parts[:: max(1, copies)]
    block = b"".join(p["block"] for p in parts)
    numbers = [p["number"] for p in parts]
    whole = copies and numbers == list(range(1, len(parts) + 1)) and parts[-1]["total"] == len(block)
    return block if whole else None


_HEAD = "record_id string, type string, uri string, refers_to string, digest string"


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in folder: record_id, type, uri, refers_to, digest (as stated),
    payload_bytes, payload_digest (bare base32 SHA-1), whole, and with `with_payload` the payload.

    whole says that all segments were there, lengths and framing were right and the digest is that
    stated; else the payload's columns are null. A revisit has no payload of its own. A record
    that stands in the archives several times is several rows. Damage ends nothing: of a cut or broken
    archive the records before it are read; a record whose length or segment number is wrong, or
    that is cut short, is a row that is not whole; a damaged continuation makes its record one.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    outcome = "payload_bytes long, payload_digest string, whole boolean, payload binary"
    names = [*re.findall(r"(\w+) \w+", _HEAD), "origin", "number", "total", "block", *re.findall(r"(\w+) \w+", outcome)]

    def decoded(block: bytes | None, stated: str | None) -> tuple:
        payload = payload_of(block) if block is not None else None
        if payload is None:
            return None, None, False, None
        digest = base32_sha1(payload)
        if stated is not None and stated != f"sha1:{digest}":
            return None, None, False, None
        return len(payload), digest, True, payload if with_payload else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [*[pa.string()] * 6, pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.string()]
        for batch in batches:
            for path, content in zip(*batch.columns):
                data, rows = content.as_py(), []
                place = hashlib.md5(path.as_py().encode()).hexdigest()
                for head, block in parse(unpacked(data)):
                    own = [head.get(k) for k in ("warc-record-id", "warc-type", "warc-target-uri", "warc-refers-to", "warc-payload-digest")]
                    number, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
                    damaged = block is None or not all(n is None or n.isdecimal() and len(n) < 19 for n in (number, total))
                    damaged = damaged or number is not None and own[1] != "continuation" and int(number) != 1
                    if number is not None and not damaged:
                        origin = head.get("warc-segment-origin-id") or own[0]
                        rows.append((*own, origin, min(int(number), _MOST_SEGMENTS), int(total) if total else None, block, None, None, None, None, head.get(_COPY.lower())))
                    elif not (damaged and own[1] == "continuation"):  # which its origin will miss
                        kept = own[1] == "revisit" and not damaged
                        result = (None, None, True, None) if kept else decoded(None if damaged else block, own[4])
                        rows.append((*own, own[0], None, None, None, *result, f"{place}-{len(rows)}"))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(types), types)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "copy"])

    found = files.mapInArrow(read, f"{_HEAD}, origin string, number int, total long, block binary, {outcome}, copy string")
    segment = F.when(F.col("number").isNotNull(), F.struct("number", "total", "block"))
    first = F.when(F.coalesce("number", F.lit(1)) == 1, F.struct(*names[:5], *names[9:]))
    # A group is one written record's segments. Only in archives of others, without the field, segments
    # of copies of a record are together.
    grouped = found.groupBy("origin", "copy").agg(F.collect_list(segment).alias("parts"), F.collect_list(first).alias("heads"))

    def assemble() -> Callable:
        def work(parts: pa.Array, heads: pa.Array) -> list[pa.Array]:
            results = []
            for own, row in zip(parts, heads):
                own, row = own.as_py(), row.as_py()
                results.append([])
                if own:
                    block = together(own)
                    result = decoded(block, row[0]["digest"] if row else None)
                    row = [dict(r, **dict(zip(names[9:], result))) for r in row]
                results[-1] = row
            kinds = [pa.field(n, pa.string()) for n in names[:5]]
            kinds += [pa.field(n, t) for n, t in zip(names[9:], (pa.int64(), pa.string(), pa.bool_(), pa.binary()))]
            return [pa.array(results, pa.list_(pa.struct(kinds)))]

        return work

    fields = f"rows array<struct<{', '.join(x.replace(' ', ':') for x in f'{_HEAD}, {outcome}'.split(', '))}>>"
    done = annotate(grouped, fields, assemble, ["parts", "heads"], ["origin"])
    rows = done.select(F.explode(added(done, "rows")).alias("r")).select("r.*")
    return rows if with_payload else rows.drop("payload")


def pages_again(records: DataFrame) -> DataFrame:
    """(record_id, type, refers_to, payload_bytes, payload_digest) of each response and revisit.

    A revisit has length and digest from the response that it refers to, if that is whole.
    """
    responses = records.where("type = 'response'")
    whole = responses.where("whole").select(
        F.col("record_id").alias("of"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")
    )
    revisits = records.where("type = 'revisit'").join(whole.distinct(), F.col("refers_to") == F.col("of"), "left")
    own = responses.select("record_id", "type", F.lit(None).cast("string").alias("refers_to"), "payload_bytes", "payload_digest")
    return own.union(revisits.select("record_id", "type", "refers_to", F.col("n"), F.col("d")))
