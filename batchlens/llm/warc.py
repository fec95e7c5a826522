"""Deterministic sharded WARC writer, and a reader.

Rows are range-sorted by page_id and digest into shards that depend on the data only (``range_shards``); within a shard they are ordered by
page_id, digest and url, nulls first. Every record is a gzip member of its own. A shard's file is rolled when its compressed size
would pass ``roll_bytes``. Headers are made anew: record ids come from page id and digest, block and payload digests and
lengths from the bytes written, dates from a parameter, so equal input gives equal bytes.

Of the records with one payload of at least ``revisit_bytes`` bytes, those with the largest page_id are responses, all others
revisits that refer to it and carry no payload. A file is written under a temporary name; the manifest (a row for each file, with its
size, SHA-1 and records) is stored from the one attempt of every task that counts, and only then do files get their final
names. Readers go by the manifest.

Defined results: a null html is an empty payload; a null url gives no target header and reads back as null; a null page_id gives
no page header, reads back as null, sorts first, and is a revisit where a row with a page_id has its payload; rows that repeat the
largest page_id with the same payload are all responses; empty tables give no files; other columns are not looked at. Memory
holds one record at a time beside the Arrow batch.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.llm.shared import TIE_BITS, commit_files, file_system, fresh_dir, range_shards, stored

REVISIT_BYTES = 1000
ROLL_BYTES = 32 << 20
SHARD_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Times a digest's row is repeated for its join, so that one payload in a third of all rows is no single task.
SALTS = 16

#: Characters that stay as they are in a target's address.
_URL = "!#$&'()*+,/:;=?@[]~-._%"

_FILES = "shard int, roll int, temp string, name string, n_records long, n_bytes long, sha1 string"
_RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page_id}:{digest}'.encode()).digest()[:16])}>"


def _b32(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def record(page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to, is_revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: {_b32(hashlib.sha1(block).hexdigest())}",
        f"WARC-Payload-Digest: {_b32(digest)}",
    ]
    if url is not None:
        plain = url.isascii() and url.isprintable() and " " not in url
        head.append(f"WARC-Target-URI: {url if plain else quote(url, safe=_URL)}")
        if not plain:
            head.append(f"X-Target-Exact: {quote(url, safe='')}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if is_revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)  # no time and no name in the member's header
    return c.compress(data) + c.flush()


class _File:
    def __init__(self, fs, base: str, shard: int, roll: int):
        self.shard, self.roll = shard, roll
        self.temp = f"_temp/{shard:08d}-{roll:05d}-{uuid.uuid4().hex}"
        self.out = fs.open_output_stream(f"{base}/{self.temp}", compression=None)
        self.sha1, self.size, self.records = hashlib.sha1(), 0, 0
        self.add(_gzip(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: " + record_id(f"file-{shard}-{roll}", "").encode()
                       + f"\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: 20\r\n\r\nformat: WARC/1.1\r\n\r\n".encode() + b"\r\n\r\n"), 0)

    def add(self, member: bytes, records: int = 1):
        self.out.write(member)
        self.sha1.update(member)
        self.size += len(member)
        self.records += records

    def close(self) -> dict:
        self.out.close()
        name = f"pages-{self.shard:08d}-{self.roll:05d}.warc.gz"
        return {"shard": self.shard, "roll": self.roll, "temp": self.temp, "name": name, "n_records": self.records, "n_bytes": self.size, "sha1": self.sha1.hexdigest()}


_FILE_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("roll", pa.int32()), ("temp", pa.string()), ("name", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha1", pa.string())]
)


def _write(root: str, roll_bytes: int, date: str):
    def run(batches):
        fs, base = file_system(root)
        file = mark = None
        for b in batches:
            cols = [b.column(c) for c in ("shard", "page_id", "url", "payload", "digest", "n_bytes", "refers_to", "kind")]
            for i in range(b.num_rows):
                shard, page, url, payload, digest, n, refers, kind = (c[i].as_py() for c in cols)
                if kind == 0:  # the rows of this page and digest that follow are revisits
                    mark = (page, digest, refers)
                    continue
                revisit = mark is not None and mark[:2] == (page, digest)
                member = _gzip(record(page, url, payload or b"", digest, n, mark[2] if revisit else None, revisit, date))
                if file and (file.shard != shard or (file.records and file.size + len(member) > roll_bytes)):
                    yield pa.RecordBatch.from_pylist([file.close()], schema=_FILE_SCHEMA)
                    file = _File(fs, base, shard, file.roll + 1 if file.shard == shard else 0)
                file = file or _File(fs, base, shard, 0)
                file.add(member)
        if file:
            yield pa.RecordBatch.from_pylist([file.close()], schema=_FILE_SCHEMA)

    return run


def write_warc(pages: DataFrame, root: str, revisit_bytes: int = REVISIT_BYTES, roll_bytes: int = ROLL_BYTES, date: str = DATE) -> DataFrame:
    """Write the archives under ``root`` (a folder of the shared store); returns the manifest."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")})
    tie = F.call_function("shiftright", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(32 - TIE_BITS))  # rises with the digest
    shard, n = range_shards(rows, "page_id", F.col("n_bytes") + 512, SHARD_BYTES, tie)
    # Which rows revisit another is found on ids and digests alone. Their few columns then travel with the pages to the shard, so
    # payloads are moved once. A row for each payload that occurs more than once is sent to SALTS places.
    ids = rows.where(F.col("n_bytes") >= revisit_bytes).select("page_id", "digest")
    copies = (
        ids.groupBy("digest").agg(F.count("*").alias("c"), F.max("page_id").alias("refers_to")).where(F.col("c") > 1).drop("c")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = ids.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    revisits = (
        salted.join(copies, ["digest", "salt"]).where(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to").distinct()
    )
    marks = revisits.select(shard.alias("shard"), "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", F.lit(0).cast("long").alias("n_bytes"), "refers_to", F.lit(0).alias("kind"))
    sent = rows.select(shard.alias("shard"), "page_id", "url", "payload", "digest", "n_bytes", F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind"))
    fs, base = file_system(root)
    fs.create_dir(f"{base}/_temp")
    ready = marks.unionByName(sent).repartition(max(1, n), "shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    return commit_files(stored(ready.mapInArrow(_write(root, roll_bytes, date), _FILES), "warc-manifest"), root)


def members(f) -> "iter":
    """The uncompressed gzip members of a file, one at a time."""
    data, rest = zlib.decompressobj(31), b""
    out = io.BytesIO()
    while True:
        chunk = rest or f.read(1 << 20)
        if not chunk:
            if out.tell():
                raise ValueError("the archive ends within a record")
            return
        rest = b""
        out.write(data.decompress(chunk))
        if data.eof:
            rest = data.unused_data
            yield out.getvalue()
            data, out = zlib.decompressobj(31), io.BytesIO()


def parse(member: bytes) -> tuple[dict, bytes]:
    """(headers, block) of a record; the digests must fit."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    n = int(headers["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    if headers.get("WARC-Block-Digest") not in (None, _b32(hashlib.sha1(block).hexdigest())):
        raise ValueError("a block's digest is wrong")
    return headers, block


def _read(root: str, with_payload: bool):
    def run(batches):
        fs, base = file_system(root)
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for b in batches:
            for name in b.column("name").to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for member in members(f):
                        h, block = parse(member)
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = base64.b32decode(h["WARC-Payload-Digest"][5:]).hex()
                        length = int(http.rpartition(b": ")[2])
                        if h["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
                            raise ValueError("a payload's digest is wrong")
                        url = unquote(h["X-Target-Exact"]) if "X-Target-Exact" in h else h.get("WARC-Target-URI")
                        page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page")
                        rows.append(
                            (page and int(page), url, payload if with_payload and h["WARC-Type"] == "response" else None, length, digest, h["WARC-Type"], refers and int(refers))
                        )
                        size += len(payload)
                        if size > 8 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return run


def read_warc(manifest: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives: page_id, url, payload (of responses, on request), payload_bytes and payload_digest of the full
    payload, record_type, refers_to. Lengths and digests are checked on the way."""
    return manifest.select("name", "shard", "roll").repartition(max(1, manifest.count()), "shard", "roll").mapInArrow(_read(root, with_payload), _RECORDS)


def new_root(spark: SparkSession) -> str:
    return fresh_dir(spark, "warc")


#: DuckDB SQL for the records of table ``pages``.
SQL = """
with p as (select page_id, coalesce(html, '') h from pages),
d as (select page_id, octet_length(encode(h)) payload_bytes, sha1(h) payload_digest from p),
m as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end top from d)
select page_id, cast(payload_bytes as bigint) payload_bytes, payload_digest,
  case when top is not null and page_id is distinct from top then 'revisit' else 'response' end record_type,
  case when top is not null and page_id is distinct from top then top end refers_to
from m
"""
