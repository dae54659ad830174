"""Legacy ARC archives converted to WARC, and both written and read as files by Spark tasks.

Archives are files of Spark's text sink whose rows are records and whose line separator ends a record, so any store
and committer that Spark knows will do, and no archive passes through the driver. An archive holds what one task had.
The converter reads the version block of each ARC file and parses its header lines by that version (5 fields in
version 1, 10 in version 2), takes contents by their declared lengths, and gives each record a WARC identifier, date,
type and digests. Equal payloads become revisits of one response. Archives of others are read as well: any file name,
gzip with one member per record, payloads of any bytes.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.llm.store import new_path, table, written

#: Fixed values of the ARC file format: the header fields of both versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CRLF = b"\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's name space of URLs
_PART = "#page_id="


def _write_archives(rows: DataFrame, path: str, end: str) -> None:
    # a cast from binary keeps the bytes as they are, and the text sink writes them as they are
    (rows.select(F.col("value").cast("string")).write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _inflated(data: memoryview) -> bytes:
    """The content of all members of a gzip file."""
    at, parts = 0, []
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(data):
                raise ValueError("gzip member without end")
            part = data[at:at + (1 << 16)]
            parts.append(member.decompress(part))
            at += len(part) - len(member.unused_data)
        while at < len(data) and data[at] == 0:  # padding
            at += 1
    return b"".join(parts)


def _decoded(head: bytes) -> str:
    """Header text: UTF-8, or Latin-1 where it is not."""
    try:
        return head.decode("utf-8", "surrogatepass")
    except UnicodeDecodeError:
        return head.decode("latin-1")


def _content(batch: pa.RecordBatch) -> Iterator[bytes]:
    for blob in batch.column("content"):
        data = blob.as_buffer()
        yield _inflated(memoryview(data)) if bytes(data[:2]) == b"\x1f\x8b" else data.to_pybytes()


def _http(payload: str | bytes) -> str:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"


def write_arc(pages: DataFrame, path: str, date: str = "20200101000000") -> None:
    """One ARC file per task, version 1 and 2 in turn: the page's HTTP response under its URL (page_id as fragment)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            out = []
            if not begun and batch.num_rows:
                version = 1 + batch.column("part")[0].as_py() % 2
                body = f"{version} 0 hourcast\n{ARC_FIELDS[version]}\n"
                rest = "" if version == 1 else " 200 - - 0 -"
                out.append(f"filedesc://archive 0.0.0.0 {date} text/plain{rest} {len(body)}\n{body}")
                begun = True
            for page_id, url, html in zip(batch.column("page_id"), batch.column("url"), batch.column("html")):
                payload = html.as_py() or ""
                block = _http(payload.encode("utf-8", "surrogatepass")) + payload
                where = quote(url.as_py() or "urn:unknown", safe="%/:=&?~#+!$,;'@()*[]")
                where += "" if page_id.as_py() is None else f"{_PART}{page_id.as_py()}"
                size = len(block.encode("utf-8", "surrogatepass"))
                rest = "" if version == 1 else " 200 - - 0 -"
                out.append(f"{where} 0.0.0.0 {date} text/html{rest} {size}\n{block}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    rows = pages.select("page_id", "url", "html", F.spark_partition_id().alias("part"))
    _write_archives(rows.mapInArrow(run, "value string"), path, "\n")


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file after its version block: url, ip, date, mime, status, block (bytes of the declared length)."""
    at, fields = 0, None
    while at < len(data):
        line_end = data.find(b"\n", at)
        if line_end < 0:
            raise ValueError(f"ARC header line without end at byte {at}")
        values = _decoded(data[at:line_end]).split(" ")
        first = line_end + 1
        block = data[first:first + int(values[-1])]
        if len(block) != int(values[-1]):
            raise ValueError(f"ARC record at byte {at} is shorter than its declared length")
        at = first + len(block)
        while data[at:at + 1] == b"\n":
            at += 1
        if fields is None:
            if not values[0].startswith("filedesc:"):
                raise ValueError("ARC file without a version block")
            fields = ARC_FIELDS[int(block.split(b" ", 1)[0])].split(" ")
            continue
        if len(values) != len(fields):
            raise ValueError(f"ARC header with {len(values)} fields; its version has {len(fields)}")
        row = dict(zip(fields, values))
        yield {"url": row["URL"], "ip": row["IP-address"], "date": row["Archive-date"], "mime": row["Content-type"], "status": row.get("Result-code"), "block": block}


def _identified(record: dict) -> tuple[int | None, str, bytes, bytes]:
    """page_id, URL, HTTP header and payload of a record."""
    url, _, page = record["url"].rpartition(_PART)
    if not _ or not re.fullmatch(r"-?\d{1,18}", page):
        url, page = record["url"], ""
    head, split, payload = record["block"].partition(CRLF + CRLF)
    if not head.startswith(b"HTTP/"):
        head, split, payload = b"", b"", record["block"]
    return int(page) if page else None, url, head + split, payload


def arc_digests(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_digest, payload_bytes) of each record of the ARC files under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, sizes = [], [], []
            for data in _content(batch):
                for record in parse_arc(data):
                    page, _, _, payload = _identified(record)
                    ids.append(page)
                    digests.append(hashlib.sha1(payload).hexdigest())
                    sizes.append(len(payload))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string()), pa.array(sizes, pa.int64())], ["page_id", "payload_digest", "payload_bytes"])

    return _archives(spark, path).mapInArrow(run, "page_id long, payload_digest string, payload_bytes long")


def revisits(digests: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the records that repeat the payload of a larger page_id."""
    keyed = digests.where(F.col("payload_bytes") >= least_bytes)
    last = keyed.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = keyed.join(last, ["payload_digest", "payload_bytes"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "payload_digest", "refers_to").distinct()


def record_id(page_id: int | None, digest: str, capture: str = "") -> str:
    """``capture`` tells apart equal payloads of records without a page_id."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}:{digest}{capture}')}>"


def warc_record(page_id: int | None, url: str, date: str, head: bytes, payload: bytes, digest: str, ip: str, mime: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.0 record without its closing CRLF CRLF."""
    block = head if revisit else head + payload
    sha1 = lambda raw: "sha1:" + base64.b32encode(raw).decode()
    kind = "revisit" if revisit else "response" if head else "resource"
    fields = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest, f':{date}:{url}' if page_id is None else '')}",
        f"WARC-Date: {date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z", f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: {sha1(bytes.fromhex(digest))}", f"WARC-Block-Digest: {sha1(hashlib.sha1(block).digest())}",
        "Content-Type: " + ("application/http; msgtype=response" if head else mime if "/" in mime else "application/octet-stream"), f"Content-Length: {len(block)}"]
    if ip not in ("", "-", "0.0.0.0"):
        fields.insert(5, f"WARC-IP-Address: {ip}")
    if page_id is not None:
        fields.insert(5, f"WARC-Page-Id: {page_id}")
    if revisit:
        fields[5:5] = ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                       f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Page-Id: {refers_to}"]
    return ("\r\n".join(fields) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 1000) -> None:
    """WARC files of the ARC files' records. Payloads move between tasks only if the list of revisits is too large for
    Spark's own broadcast threshold."""
    repeats = written(revisits(arc_digests(spark, arc_path), least_bytes), "warc-revisits")
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("date", T.StringType()), T.StructField("head", T.BinaryType()), T.StructField("payload", T.BinaryType()), T.StructField("digest", T.StringType()), T.StructField("ip", T.StringType()), T.StructField("mime", T.StringType())])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for data in _content(batch):
                rows, held = [[] for _ in names], 0
                for record in parse_arc(data):
                    page, url, head, payload = _identified(record)
                    for column, value in zip(rows, (page, url, record["date"], head, payload, hashlib.sha1(payload).hexdigest(), record["ip"], record["mime"])):
                        column.append(value)
                    held += len(payload)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)
                        rows, held = [[] for _ in names], 0
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "date", "head", "payload", "digest", "ip", "mime", "refers_to", "repeats")]
            out = [warc_record(*[v.as_py() for v in row]) for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = _archives(spark, arc_path).mapInArrow(parsed, schema).alias("a")
    marks = repeats.withColumn("repeats", F.lit(True)).alias("r")
    rows = rows.join(marks, F.col("a.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("a.digest") == F.col("r.payload_digest")), "left")
    rows = rows.select("a.*", "r.refers_to", F.coalesce("r.repeats", F.lit(False)).alias("repeats"))
    _write_archives(rows.mapInArrow(records, "value binary"), warc_path, "\r\n\r\n")


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.find(CRLF + CRLF, at)
        lines = _decoded(data[at:end]).split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        first, size = end + 4, int(fields["content-length"])
        block = data[first:first + size]
        if data[first + size:first + size + 4] != CRLF + CRLF:
            raise ValueError(f"WARC record at byte {at} does not end where its length says")
        yield fields, block
        at = first + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, payload (null for revisits), payload_bytes, payload_digest, refers_to of each record.

    A response's digest is taken from its payload and must equal the SHA-1 in its header, if that has one; a revisit's
    digest and length are those its headers state (null if they state none).
    """
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in _content(batch):
                rows, held = [[] for _ in names], 0
                for fields, block in parse_warc(data):
                    stated = fields.get("warc-payload-digest", "")
                    digest = base64.b32decode(stated[5:].upper()).hex() if stated.lower().startswith("sha1:") else None
                    head, _, payload = block.partition(CRLF + CRLF) if block.startswith(b"HTTP/") else (b"", b"", block)
                    if fields["warc-type"] == "revisit":
                        length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
                        size, payload = length and int(length[1]), None
                    else:
                        size, found = len(payload), hashlib.sha1(payload).hexdigest()
                        digest = digest or found
                        if found != digest:
                            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
                    page, refers = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
                    for column, value in zip(rows, (page and int(page), fields.get("warc-target-uri"), fields["warc-type"], payload, size, digest, refers and int(refers))):
                        column.append(value)
                    held += len(payload or b"")
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)
                        rows, held = [[] for _ in names], 0
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    return _archives(spark, path).mapInArrow(run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages written as ARC files, converted to WARC files, and read back.

    A null html is an empty payload, a null url is archived as urn:unknown, a null page_id stays null. Rows that repeat
    a page_id and payload are all responses if that page_id is the largest. No pages give no records.
    """
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc)
    convert_arc(spark, arc, warc)
    return read_warc(spark, warc)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
h AS (SELECT page_id, payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to FROM m"""
