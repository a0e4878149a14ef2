"""WARC archives with revisit records instead of repeated payloads.

Headers (digest, id, url) are shuffled by payload digest; the smallest id of a digest is its response and
every other record becomes a revisit that names it. Archives are packed from the records, written by
Spark's own writer (so a lost or repeated task leaves no stray file), and read back by parsing.

Defined cases: a null payload counts as empty; rows that repeat the smallest id of their digest are
responses too; ids that are null sort last and are responses only where all ids of the digest are
null; a null url is left out of the header; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from datetime import UTC, datetime
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stage import stage_root
from .common import sliced, table

#: Payloads of fewer bytes are always written in full.
MIN_BYTES = 0
#: Bytes of records in one archive file; one record may exceed it.
ARCHIVE_BYTES = 16 << 20
#: Alphabet of base32 (fixed values), and the profile of revisits by digest.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def base32_of_hex(digest: Column) -> Column:
    """A SHA-1 given in hex (a column, since it is used for every character) in base32: 40 hex digits are 8
    groups of 20 bits, each 4 characters."""
    out = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def resolved(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per page with its payload, digest, ``refers_to`` and ``refers_uri`` (null: a response)."""
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("hex", F.sha1("payload")).withColumn("digest", base32_of_hex(F.col("hex"))).drop("hex")
    heads = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("*").alias("records"))
    # digests of a single record need no join partner
    shared = heads.where("records > 1").select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    both = rows.join(shared, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return both.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first_id")).alias("refers_to"),
                       F.when(revisit, F.col("first_url")).alias("refers_uri"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_uri: str | None, date: str) -> bytes:
    """One WARC record without the blank lines that end it."""
    def clean(text: str) -> str:
        return "".join(text.split())

    revisit = refers_to is not None
    http = HTTP % len(payload)
    block = http if revisit else http + payload
    heads = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        heads.append(f"WARC-Target-URI: {clean(url)}")
    if revisit:
        heads += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        if refers_uri is not None:
            heads.append(f"WARC-Refers-To-Target-URI: {clean(refers_uri)}")
    else:
        heads.append("WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode())
    heads.append(f"Content-Length: {len(block)}")
    return "\r\n".join(heads).encode() + b"\r\n\r\n" + block


def information(date: str) -> bytes:
    body = b"software: corpus operators\r\nformat: WARC File Format 1.1"
    return b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s" % (
        str(uuid4()).encode(), date.encode(), len(body), body)


def write_archives(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> None:
    """Write resolved rows as gzipped archives of about ``archive_bytes`` each below ``path``.

    A record is text (ASCII headers, UTF-8 payload), so an archive is one value of Spark's text writer,
    whose line separator is the pair of blank lines that ends a record.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts:
            for piece in sliced(part):
                for row in piece.to_pylist():
                    made = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], row["refers_uri"], date)
                    if held and size + len(made) > archive_bytes:
                        yield archive(held)
                        held, size = [], 0
                    held.append(made)
                    size += len(made)
        if held:
            yield archive(held)

    def archive(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join([information(date), *records])], pa.binary())], ["value"])

    (rows.mapInArrow(pack, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, by the lengths it states."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        heads = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(heads["Content-Length"])
        yield heads, data[start:start + size]
        at = start + size + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives: page_id, url, record_type, payload (null for revisits), payload_digest
    (of the payload itself where it is there), refers_to, refers_uri."""
    def number(text: str | None) -> int | None:
        inner = text[len("<urn:page:"):-1] if text else ""
        return int(inner) if inner else None

    def records(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip
        for part in parts:
            for content in part.column(0):
                rows = []
                for heads, block in parsed(gzip.decompress(content.as_py())):
                    kind = heads["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    payload = block[block.index(b"\r\n\r\n") + 4:] if kind == "response" else None
                    stated = heads["WARC-Payload-Digest"].removeprefix("sha1:")
                    found = stated if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != stated:
                        raise ValueError(f"payload of {heads['WARC-Record-ID']} does not have the digest {stated}")
                    rows.append({"page_id": number(heads["WARC-Record-ID"]), "url": heads.get("WARC-Target-URI"), "record_type": kind,
                                 "payload": payload, "payload_digest": found, "refers_to": number(heads.get("WARC-Refers-To")),
                                 "refers_uri": heads.get("WARC-Refers-To-Target-URI")})
                yield pa.RecordBatch.from_pylist(rows, arrow)

    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                       ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_uri", pa.string())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(records, "page_id long, url string, record_type string, payload binary, payload_digest string, refers_to long, refers_uri string")


def payload_sizes(records: DataFrame) -> DataFrame:
    """Every record with the bytes of its full payload: a revisit's come from the response it refers to."""
    sized = records.select("page_id", "record_type", "payload_digest", "refers_to", F.octet_length("payload").alias("payload_bytes"))
    responses = sized.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = sized.where("record_type = 'revisit'").drop("payload_bytes").join(responses, ["refers_to", "payload_digest"], "left")
    return sized.where("record_type = 'response'").unionByName(revisits)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives of all pages and returns what reading them gives."""
    path = f"{stage_root(spark)}/cliniform/{uuid4().hex}/warc"
    write_archives(resolved(table(spark, sf_dir, "pages")), path)
    return payload_sizes(read_archives(spark, path)).select("page_id", F.col("payload_bytes").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


#: DuckDB has no base32 of a digest: its hex digits are cut into groups of 20 bits, as above.
_B32 = " || ".join(f"substr('{BASE32}', 1 + ((('0x' || substr(d, {5 * g + 1}, 5))::int >> {s}) & 31), 1)" for g in range(8) for s in (15, 10, 5, 0))
OP5_SQL = f"""with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, strlen(h) as payload_bytes, sha1(h) as d from p),
r as (select *, min(page_id) over (partition by d) as first from q)
select page_id, payload_bytes, {_B32} as payload_digest,
case when page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
case when page_id is distinct from first then first end as refers_to from r"""
