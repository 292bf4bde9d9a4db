"""WARC: archives of one gzip member per record, and a sequential reader that verifies what it reads."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import bounded_batches, materialised, scratch, table

#: Fixed values of the format.
VERSION, CRLF = b"WARC/1.1", b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = 1 << 16


class DamagedArchive(ValueError):
    """An archive that isn't framed as stated, is cut off, or whose digests don't agree with its content."""


#: Names of records: the id with every sign but letters, digits and ``_.-~`` written as its bytes; a page without id has none.
NAME, NO_NAME = "<urn:page:%s>", "<urn:page>"


def name_of(page_id) -> str:
    return NO_NAME if page_id is None else NAME % quote(str(page_id), safe="")


def id_of(name: str) -> str | None:
    if name == NO_NAME:
        return None
    start, end = NAME.split("%s")
    if not (name.startswith(start) and name.endswith(end)):
        raise DamagedArchive(f"no page's name: {name[:80]}")
    return unquote(name[len(start):-len(end)])


def field(fields: dict[str, str], name: str) -> str:
    """A field that a record must have."""
    if name not in fields:
        raise DamagedArchive(f"a record without {name}")
    return fields[name]


def length_of(text: str | bytes) -> int:
    text = text.decode("ascii", "replace") if isinstance(text, bytes) else text
    if not (text.strip().isascii() and text.strip().isdigit()):
        raise DamagedArchive(f"no length: {text[:80]!r}")
    return int(text)


def record(page_id, url: str | None, payload: bytes | None, length: int, digest: str, refers_to, date: str) -> bytes:
    """A response with its payload, or a revisit (``payload`` null) with the headers of a response only; not compressed."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % length, b"", b""])
    block = http + (payload or b"")
    named = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", name_of(page_id)),
             ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        named.append(("WARC-Target-URI", "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in url.encode()).encode("latin-1").decode()))
    if payload is None:
        named += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name_of(refers_to))]
    named += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
              ("Content-Length", str(len(block)))]
    head = CRLF.join([VERSION, *[f"{k}: {v}".encode() for k, v in named], b"", b""])
    return head + block + CRLF + CRLF


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without time stamp."""
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def records_of(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, one gzip member after the other.

    Holds one record at a time. Each member must hold exactly one record: a version line, fields, a block of the
    stated length and two line ends.
    """
    rest = b""
    while rest or (rest := stream.read(READ)):
        unzip, parts = zlib.decompressobj(31), []
        while True:
            try:
                parts.append(unzip.decompress(rest))
            except zlib.error as error:
                raise DamagedArchive(f"no gzip member: {error}") from error
            rest = unzip.unused_data
            if unzip.eof:
                break
            rest = stream.read(READ)
            if not rest:
                raise DamagedArchive("the last member is cut off")
        yield framed(b"".join(parts))


def framed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, gap, body = data.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not gap or lines[0] != VERSION:
        raise DamagedArchive("a member doesn't start with a record's version line and fields")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise DamagedArchive(f"no field: {name[:80]}")
        fields[name.lower()] = value.strip()
    size = length_of(field(fields, "content-length"))
    if len(body) != size + 4 or body[size:] != CRLF + CRLF:
        raise DamagedArchive(f"a block of {size} bytes is stated, {len(body) - 4} found")
    return fields, body[:size]


def verified(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int, str]:
    """Payload (null for a revisit), the full payload's length and digest, after checking both digests."""
    name, kind = field(fields, "warc-record-id"), field(fields, "warc-type")
    if field(fields, "warc-block-digest") != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise DamagedArchive(f"block digest of {name}")
    if kind not in ("response", "revisit"):
        raise DamagedArchive(f"{name} is a {kind[:80]}")
    http, gap, payload = block.partition(CRLF + CRLF)
    length = next((length_of(v) for k, _, v in (x.partition(b":") for x in http.split(CRLF)) if k.lower() == b"content-length"), None)
    stated = re.fullmatch("sha256:([0-9a-f]{64})", field(fields, "warc-payload-digest"))
    if not stated:
        raise DamagedArchive(f"no digest in {name}")
    digest = stated[1]
    if not gap or length is None:
        raise DamagedArchive(f"no HTTP headers in {name}")
    if kind == "revisit":
        field(fields, "warc-refers-to")
        return None, length, digest
    if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
        raise DamagedArchive(f"payload digest of {name}")
    return payload, length, digest


def archive_writer(folder: str, date: str, most_bytes: int):
    """Task function: writes the task's pages to archives of about ``most_bytes`` and lists those that are complete.

    Names are new for each attempt, so a task that is run again, or twice, leaves files that no list names.
    """
    def run(batches):
        files, base = fs.FileSystem.from_uri(folder)
        sink, name, size, n, listed = None, "", 0, 0, []
        for batch in batches:
            for page_id, url, html, refers_to, digest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if sink is None:
                    name, size, n = f"{base}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = files.open_output_stream(name, compression=None)
                payload = html or b""
                data = member(record(page_id, url, payload if refers_to is None else None, len(payload), digest, refers_to, date))
                sink.write(data)
                size, n = size + len(data), n + 1
                if size >= most_bytes:
                    sink.close()
                    sink = None
                    listed.append((name, n, size))
        if sink is not None:
            sink.close()
            listed.append((name, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in listed], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         names=["archive", "records", "bytes"])
    return run


def archive_reader(folder: str):
    """Task function: the verified records of each listed archive, in batches of bounded size."""
    schema = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def run(batches):
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, stated in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows, size, n = [], 0, 0
                with files.open_input_stream(name, compression=None) as stream:
                    for fields, block in records_of(stream):
                        payload, length, digest = verified(fields, block)
                        refers_to = id_of(fields["warc-refers-to"]) if payload is None else None
                        rows.append((id_of(fields["warc-record-id"]), fields.get("warc-target-uri"), length, digest,
                                     fields["warc-type"], refers_to, payload))
                        n, size = n + 1, size + len(block)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
                            rows, size = [], 0
                if n != stated:
                    raise DamagedArchive(f"{name} holds {n} records of {stated}")
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 100, date: str = "1970-01-01T00:00:00Z", most_bytes: int = 256 << 20) -> DataFrame:
    """Write a record per page below ``folder`` and return the list of archives: ``archive, records, bytes``.

    The payload is the page in UTF-8; null is empty. Of pages with equal payloads of at least ``least_bytes``, the one with
    the smallest id is the response and the others revisit it; smaller payloads are all responses. Rows that repeat the
    response's id are responses too, and pages without id always are. An empty table gives an empty list.

    Only digests are grouped: a group of copies is a partial minimum. The pages of groups of one aren't in the list of
    revisits that the pages are joined with.
    """
    bounded_batches(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256))
    sizes = base.where(F.octet_length("payload") >= least_bytes).select("id", "digest")
    first = sizes.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = materialised(first, "repeated-payloads")
    placed = base.join(first, "digest", "left").select(
        "id", "url", "payload", F.when((F.octet_length("payload") >= least_bytes) & (F.col("id") != F.col("refers_to")), F.col("refers_to")), "digest")
    return materialised(placed.mapInArrow(archive_writer(folder, date, most_bytes), "archive string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """Read listed archives back: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``.

    Each archive is read by one task from start to end with a record in memory at a time; cut-off members, wrong lengths,
    wrong digests, absent or malformed fields and missing records stop the job. Ids are read as ``id_type``. A revisit has no payload of its own; length and digest are the full payload's.
    """
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
    rows = archives.select("archive", "records").mapInArrow(archive_reader(folder), schema)
    return rows.select(F.col("page_id").cast(id_type), "url", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type), "payload")


def op8_warc(spark, folder: str) -> DataFrame:
    archives = scratch(spark, "warc")
    files, base = fs.FileSystem.from_uri(archives if "://" in archives or archives.startswith("file:") else f"file://{archives}")
    files.create_dir(base, recursive=True)
    archives = archives if "://" in archives or archives.startswith("file:") else f"file://{archives}"
    listed = write_archives(table(spark, folder, "pages"), archives)
    # The list is small; deal it out so that archives are read side by side.
    return read_archives(listed.repartition(max(1, listed.count())), archives).drop("url", "payload")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
