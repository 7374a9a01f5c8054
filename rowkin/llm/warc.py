"""WARC archives with revisit records.

Headers alone (id, URL, digests, length) are shuffled, by payload digest: a group of equal payloads
gives the record that is the response. What digests occur twice or more then goes back to the
pages: as a broadcast table while it is small (its rows are counted first), else pages that a
bit map of all such digests rules out stay where they are and only the others are joined. Bodies of pages whose payload is
unlike all others never move.

Every partition writes its records with fresh headers, each record a gzip member of its own, gathered to chunks
of a bounded number of bytes, so that files are bounded too. Files are written by Spark's text
writer: they go to any store Spark can write, with its commit protocol. The last byte of a member (the highest of
its four-byte length) is 0 and serves as the writer's line separator, so the bytes are those of the members alone.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_folder
from .common import modest, small

#: Equal payloads of at least so many bytes are written once.
MIN_BYTES = 0
#: Compressed bytes of a chunk, and chunks of a file. A record is never cut.
CHUNK_BYTES, CHUNKS_A_FILE = 8 << 20, 8
#: Digests that occur twice or more are broadcast up to this number (some 100 bytes each).
BROADCAST_ROWS = 500_000
#: Bits of the map of digests that occur twice or more, beyond that: 16 MB.
MAP_BITS = 27
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
SOFTWARE = "rowkin"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
#: What may stand in a header as it is; anything else is percent-encoded.
SAFE = "!#$%&'()*+,/:;=?@[]~-._"
#: An empty member, put after a record of 16 MB and more, whose length doesn't end in a byte 0.
EMPTY = zlib.compressobj(6, zlib.DEFLATED, 31).flush()


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    """The name of a page's record; rows that repeat both id and payload share it."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}').urn}>"


def with_digests(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """_id, _url, _html, _sha (hexadecimal), _check, _bytes of each page; null html is an empty payload."""
    plain = modest(pages).select(F.col(page_id).cast("long").alias("_id"), F.col(url).cast("string").alias("_url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("_html"))
    return plain.select("*", F.sha1("_html").alias("_sha"), F.xxhash64("_html").alias("_check"), F.octet_length("_html").cast("long").alias("_bytes"))


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """_sha, _check, _bytes, _first, _first_url of the payloads that occur more than once: the response has the largest id; null ids are smallest."""
    found = headers.where(F.col("_bytes") >= min_bytes).groupBy("_sha", "_check", "_bytes").agg(F.max(F.when(F.col("_id").isNotNull(), F.struct("_id", "_url"))).alias("_f"), F.count(F.lit(1)).alias("_n"))
    return found.where("_n > 1").select("_sha", "_check", "_bytes", F.col("_f._id").alias("_first"), F.col("_f._url").alias("_first_url"))


def _place(sha: Column) -> Column:
    """The bit of a digest in the map: its first ``MAP_BITS`` bits."""
    return F.shiftright(F.conv(F.substring(sha, 1, 8), 16, 10).cast("long"), 32 - MAP_BITS)


def digest_map(firsts: DataFrame) -> np.ndarray:
    """A bit for the place of each digest of ``firsts``: ``2 ** MAP_BITS / 8`` bytes, whatever their number."""
    rows = firsts.select(_place(F.col("_sha")).alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("bits"))
    found, out = rows.toPandas(), np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[found["at"]] = found["bits"]
    return out


def with_kinds(rows: DataFrame, firsts: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` with _first, _first_url of their payload where it occurs more than once."""
    keys = ["_sha", "_check", "_bytes"]
    if firsts.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(firsts), keys, "left")
    bits = digest_map(firsts)

    @F.pandas_udf("boolean")
    def listed(place):
        p = place.to_numpy(np.int64)
        return place.__class__((bits[p >> 6] >> (p & 63) & 1).astype(bool))

    marked = rows.withColumn("_listed", listed(_place(F.col("_sha"))))
    alone = marked.where("NOT _listed").select("*", F.lit(None).cast("long").alias("_first"), F.lit(None).cast("string").alias("_first_url"))
    return alone.unionByName(marked.where("_listed").join(firsts, keys, "left")).drop("_listed")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES, date: datetime.datetime | None = None, broadcast_rows: int = BROADCAST_ROWS) -> None:
    """One record for each page. Of equal payloads, one is a response and the others revisit it.

    Null html: an empty payload. Null url: no target URI. Null id: a response of its own. A row
    that repeats another with the same id is a response as well, as it has no other id to refer to.
    Ids are whole numbers. An empty table gives an archive without records. ``date`` is that of the records, now by default.
    """
    rows = with_digests(pages, page_id, url, html)
    firsts = resolve_revisits(rows.drop("_html"), min_bytes)
    kinds = with_kinds(rows, firsts, broadcast_rows)
    revisit = F.coalesce(F.col("_id") != F.col("_first"), F.lit(False))
    kinds = kinds.select("_id", "_url", F.when(~revisit, F.col("_html")).alias("_html"), "_sha", "_bytes", F.when(revisit, F.col("_first")).alias("_to"), F.when(revisit, F.col("_first_url")).alias("_to_url"))
    when = (date or datetime.datetime.now(datetime.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def chunk() -> pa.RecordBatch:
            whole = b"".join([member(warcinfo(when)), *held])
            return pa.RecordBatch.from_arrays([pa.array([whole[:-1]], pa.binary())], ["value"])

        for b in small(batches):
            for x in b.to_pylist():
                held.append(member(record(**x, date=when)))
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield chunk()
                    held, size = [], 0
        if held:
            yield chunk()

    made = kinds.mapInArrow(chunks, "value binary")
    # A cast doesn't look into the bytes, and the writer copies them.
    made.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", CHUNKS_A_FILE).text(path)


def member(data: bytes) -> bytes:
    """``data`` as a gzip member whose last byte is 0."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out[-1] == 0 else out + EMPTY


def warcinfo(date: str) -> bytes:
    body = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <{uuid.uuid5(uuid.NAMESPACE_URL, f'warcinfo:{date}').urn}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + END + body + END


def record(_id: int | None, _url: str | None, _html: bytes | None, _sha: str, _bytes: int, _to: int | None, _to_url: str | None, date: str) -> bytes:
    """The bytes of one record; ``_html`` None: a revisit of ``_to``."""
    digest = base64.b32encode(bytes.fromhex(_sha)).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {_bytes}".encode() + END + (_html or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if _to is None else 'revisit'}", f"WARC-Record-ID: {record_id(_id, digest)}", f"WARC-Date: {date}"]
    if _url is not None:
        head.append(f"WARC-Target-URI: {quote(_url, safe=SAFE)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if _to is not None:
        head += [f"WARC-Refers-To: {record_id(_to, digest)}", f"WARC-Refers-To-Date: {date}", f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {_to}"]
        if _to_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {quote(_to_url, safe=SAFE)}")
    if _id is not None:
        head.append(f"X-Page: {_id}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def members(data: bytes) -> Iterator[bytes]:
    """The contents of the gzip members of ``data``, one at a time; empty ones are passed over."""
    at = memoryview(data)
    while len(at):
        unpacker = zlib.decompressobj(31)
        found, left = [], at
        while not unpacker.eof:
            # Pieces of the input keep what is left over small.
            found.append(unpacker.decompress(left[: 1 << 16]))
            if not unpacker.eof and len(left) <= 1 << 16:
                raise ValueError("an archive ends within a record")
            left = left[1 << 16 :] if not unpacker.eof else left[min(1 << 16, len(left)) - len(unpacker.unused_data) :]
        at = left
        content = b"".join(found)
        if content:
            yield content


def parse(content: bytes) -> dict | None:
    """The record that a member holds; None for a warcinfo."""
    end = content.index(END)
    head = dict(re.findall(r"(?m)^([\w-]+): (.*?)\r?$", content[:end].decode()))
    size = int(head["Content-Length"])
    block = content[end + 4 : end + 4 + size]
    if len(block) != size or content[end + 4 + size :] != END:
        raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
    if head["WARC-Type"] == "warcinfo":
        return None
    split = block.index(END)
    http, payload = block[:split].decode(), block[split + 4 :]
    revisit = head["WARC-Type"] == "revisit"
    said = int(re.search(r"Content-Length: (\d+)", http)[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (said != len(payload) or digest != payload_digest(payload)):
        raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
    return {
        "page_id": int(head["X-Page"]) if "X-Page" in head else None,
        "url": head.get("WARC-Target-URI"),
        "payload_bytes": said,
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": int(head["X-Refers-To-Page"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives at ``path``. A file, of a bounded number of bytes, is read by one task, a record at a time.

    Response payloads are held against their digest; a revisit has no payload of its own.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(RECORD_SCHEMA))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column("content"):
                found = []
                for content in members(file.as_py()):
                    one = parse(content)
                    if one is not None:
                        found.append(one)
                    if len(found) == 256:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found = []
                yield pa.RecordBatch.from_pylist(found, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parsed, RECORD_SCHEMA)


def archived(pages: DataFrame, min_bytes: int = MIN_BYTES, **how) -> DataFrame:
    """The records of ``pages``, read back from archives in the shared folder."""
    path = new_folder(pages.sparkSession, "warc")
    write_warc(pages, path, min_bytes=min_bytes, **how)
    return read_warc(pages.sparkSession, path)
