"""WARC archives without repeated payloads: revisit records are resolved by payload digest.

**Headers.** The digest and size of each payload are worked out where the rows are read.  Only these headers are shuffled, by digest:
each digest has one response, the record with a payload and the smallest page_id, and the other records of that digest are joined to it as
revisits.  Digests of at least 1 / ``HEAVY_PART`` of all records, of which there are ``HEAVY_PART`` at most, are joined by broadcast, so
no task gets all copies of one payload.
**Archives.** Every record is a gzip member of its own with fresh headers; Spark's text writer stores the members, so a lost task
is simply repeated and only whole files appear.  That writer ends each row with a separator: it is a zero byte, the last
one of a member whose record has less than 16 MiB.  Longer records are followed by an empty member, which ends alike.
**Reading.** Files are read whole, one record in memory at a time.  The digest of a stored payload is worked out again; ``resolved`` joins the
revisits that were read to the responses that were read, which gives them their payload's size and page.

Null payloads of ``page_records`` are empty ones; payloads below ``min_bytes`` bytes are always stored.  A record without a
page_id can revisit another but is never revisited: where all records of a digest lack one, all are responses.  Rows that repeat page_id and
payload of a response are responses too.  A revisit without any response of its digest stays one, and keeps what it referred to.  Null
urls have no header, control characters and blanks in urls are percent-encoded, and extra columns are ignored.  No rows give no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.session import written

from .registry import discard

HEAVY_PART = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_READ = 1 << 16
_GIVEN = 4 << 20  # bytes of payload handed on at a time


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32: each five hexadecimal digits are four letters."""
    return F.get(F.transform(F.array(F.sha1(payload)), lambda digest: F.concat(*[
        F.substring(F.lit(_BASE32), F.shiftright(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int"), shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
        for i in range(8) for shift in (15, 10, 5, 0)])), 0)


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, url and payload of web pages (page_id, url, html)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.cast("binary").alias("payload"))


def _with_digests(records: DataFrame) -> DataFrame:
    """The records with digest and size; those of records without payload are taken over."""
    known = {c: F.col(c) if c in records.columns else F.lit(None) for c in ("payload_digest", "payload_bytes", "refers_to")}
    digest = F.when(F.col("payload").isNull(), known["payload_digest"].cast("string")).otherwise(payload_digest(F.col("payload")))
    size = F.when(F.col("payload").isNull(), known["payload_bytes"].cast("long")).otherwise(F.octet_length("payload").cast("long"))
    return records.select("page_id", "url", "payload", known["refers_to"].cast("long").alias("refers_to"), digest.alias("digest"), size.alias("size"))


def _by_digest(left: DataFrame, responses: DataFrame, total: int, how: str) -> DataFrame:
    """Join on the digest; ``copies`` says how many rows of ``left`` a response meets, of ``total`` in all."""
    heavy = F.col("copies") * HEAVY_PART >= max(total, 1)
    often = F.broadcast(responses.where(heavy).drop("copies"))  # HEAVY_PART rows at most
    once = left.join(often.withColumn("met", F.lit(True)), "digest", "left")
    found = once.where("met").drop("met")
    rest = once.where("met is null").select(*left.columns).join(responses.where(~heavy).drop("copies"), "digest", how)
    return found.unionByName(rest)


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, digest, original and original_url of each record that need not be stored; ``headers`` is a written table.

    ``headers`` has page_id, url, digest, size and ``stored``, whether the record has a payload.
    """
    stored = F.when(F.col("stored"), F.col("page_id"))
    groups = headers.groupBy("digest").agg(F.min_by(F.struct("page_id", "url"), stored).alias("first"), F.count("*").alias("copies"))
    responses = groups.where("copies > 1 and first.page_id is not null").select("digest", F.col("first.page_id").alias("original"), F.col("first.url").alias("original_url"), "copies")
    met = _by_digest(headers.select("page_id", "digest", "size", "stored"), responses, headers.count(), "inner")
    later = ~F.col("stored") | ((F.col("size") >= min_bytes) & F.coalesce(F.col("page_id") > F.col("original"), F.lit(True)))
    return met.where(later).select("page_id", "digest", "original", "original_url").distinct()


def write_archives(records: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Write records (page_id, url, payload) as deduplicated archives.

    A null payload is a revisit from an archive read before, with payload_digest, payload_bytes and refers_to.
    """
    full = _with_digests(records)
    headers = written(full.select("page_id", "url", "digest", "size", F.col("payload").isNotNull().alias("stored")), "warc-headers")
    later = written(revisits(headers, min_bytes), "warc-revisits")
    discard(headers)
    same = F.col("r.page_id").eqNullSafe(F.col("v.page_id")) & (F.col("r.digest") == F.col("v.digest"))
    joined = full.alias("r").join(later.withColumn("later", F.lit(True)).alias("v"), same, "left")
    is_revisit = F.coalesce(F.col("later"), F.lit(False)) | F.col("payload").isNull()
    rows = joined.select("r.page_id", "r.url", "r.digest", "r.size", is_revisit.alias("revisit"), F.coalesce("original", "refers_to").alias("refers_to"),
                         "original_url", F.when(~is_revisit, F.col("payload")).alias("payload"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members, held = [], 0
            for row in range(len(batch)):
                members.append(member(record(*(c[row].as_py() for c in batch.columns), date)))
                held += len(members[-1])
                if held >= _GIVEN:
                    yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])
                    members, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])

    rows.mapInArrow(pack, "member binary").select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)
    discard(later)


def record(page_id, url, digest, size, revisit, refers_to, refers_to_url, payload, date) -> bytes:
    """One WARC record with its closing blank lines."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"Content-Length: {size}\r\n" if size is not None else "") + "\r\n"
    block = http.encode() + (b"" if revisit else payload)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI": _uri(url),
        "WARC-Date": date,
        "WARC-Payload-Digest": None if digest is None else f"sha1:{digest}",
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": f"<urn:page:{refers_to}>" if revisit and refers_to is not None else None,
        "WARC-Refers-To-Target-URI": _uri(refers_to_url) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _uri(url: str | None) -> str | None:
    if url is None:
        return None
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def member(data: bytes) -> bytes:
    """A gzip member (two for a long record) without its last byte, which is zero."""
    gzip = lambda x: (z := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(x) + z.flush()
    whole = gzip(data)
    if whole[-1]:
        whole += gzip(b"")
    return whole[:-1]


def members(data) -> Iterator[bytes]:
    """The content of each gzip member, read in pieces."""
    at, view = 0, memoryview(data)
    while at < len(view):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(view):
                raise ValueError("an archive ends inside a record")
            piece = view[at:at + _READ]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        whole = b"".join(parts)
        if whole:
            yield whole


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP header and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}
    size = int(fields["content-length"])
    if len(rest) != size + 4:
        raise ValueError(f"a record of {size} bytes has {len(rest) - 4}")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, http, payload


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of archives: page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload.

    Digest and size of a response are those of the bytes read; a revisit has the digest it names, and no size.  Without ``payloads`` that
    column is null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        give = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names=names)
        for batch in batches:
            for cell in batch.column("content"):
                rows, held = [], 0
                for data in members(cell.as_buffer()):
                    fields, _, payload = parse(data)
                    revisit = fields["warc-type"] == "revisit"
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    rows.append((_page(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], _page(fields.get("warc-refers-to")),
                                 digest or None, None if revisit else len(payload), payload if payloads and not revisit else None))
                    held += 200 + (len(payload) if payloads else 0)
                    if held >= _GIVEN:
                        yield give(rows)
                        rows, held = [], 0
                yield give(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """Records as read, each revisit with the size of the response it is joined to by digest, and its page_id as ``refers_to``."""
    heads = written(records.select("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes"), "warc-read")
    late = heads.where("record_type = 'revisit'").withColumnRenamed("payload_digest", "digest")
    groups = heads.withColumnRenamed("payload_digest", "digest").groupBy("digest").agg(
        F.min(F.when(F.col("record_type") != "revisit", F.struct("page_id", F.col("payload_bytes").alias("n")))).alias("first"),
        F.count(F.when(F.col("record_type") == "revisit", 1)).alias("copies"))
    responses = groups.where("copies > 0 and first is not null").select("digest", F.col("first.page_id").alias("response"), F.col("first.n").alias("n"), "copies")
    joined = _by_digest(late, responses, heads.count(), "left").select(
        "page_id", "url", "record_type", F.coalesce("response", "refers_to").alias("refers_to"), F.col("digest").alias("payload_digest"),
        F.col("n").alias("payload_bytes"))
    return heads.where("record_type <> 'revisit'").unionByName(joined)
