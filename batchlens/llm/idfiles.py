"""Token ids in binary files: frequency-ranked ids, byte-aligned variable length, control bytes apart.

The commonest id of the corpus has rank 0. A rank takes one to four bytes, little-endian; its length less one is two bits of
a control byte, so a control byte serves four ids. A file holds blocks of up to BLOCK ids, then the index of its documents:

    "IDRANK01"
    block*:  uint32 ids, uint32 data bytes, control bytes, data bytes
    index:   int64 doc_id[n], uint8 is_null[n], int64 n_ids[n]
    uint64 n, uint64 ids, uint64 offset of the index, "IDRANK01"

``ranks.bin`` beside the files holds the id of every rank as uint32. Decoding looks the control bytes up in a table of
lengths and gathers bytes with numpy.

Documents go to files by ranges of doc_id and the text's hash (``range_shards``), in ascending order within and over files; ties are ordered by a
hash of the text, null ids come first. Ids are first put down plainly (compressed) with their counts, so each text is encoded once;
the ranks are then known (one number for each id of the vocabulary comes to the driver) and the files are written. Files get their
final names after the manifest of the one attempt that counts is stored.

Defined results: a null or empty text is the end id alone; rows are documents each, repeated or not; empty tables give no files
and an empty result; other columns are not looked at. Memory holds one block and one batch of texts, whatever a text's length
but for the encoding of that one text.
"""

from __future__ import annotations

import io
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchlens.llm import textvec
from batchlens.llm.shared import TIE_BITS, commit_files, file_system, fresh_dir, range_shards, stored
from batchlens.llm.tokens import encoder

MAGIC = b"IDRANK01"
BLOCK = 1 << 20
SHARD_BYTES = 16 << 20

_PLAIN = "shard int, temp string, n_docs long, n_ids long, ids array<int>, counts array<long>"
_FILES = "shard int, temp string, name string, n_docs long, n_ids long, n_bytes long"

#: Lengths of the four ids of every control byte.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


# ---------------------------------------------------------------- coding


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes)."""
    r = np.ascontiguousarray(ranks, "<u4")
    more = (r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)
    four = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    four[: len(r)] = more
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4, dtype=np.uint8)[None, :] <= more[:, None]
    return control.astype(np.uint8).tobytes(), r.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Ranks of a block, by looking the control bytes up in LENGTHS."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    end = np.cumsum(length, dtype=np.int64)
    start = end - length
    d = np.frombuffer(data, np.uint8)
    out = d[start].astype(np.uint32)
    for k in range(1, 4):
        at = np.flatnonzero(length > k)
        if len(at):
            out[at] |= d[start[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class _Index:
    def __init__(self):
        self.ids, self.sizes = [], []

    def bytes(self) -> bytes:
        ids = np.array([0 if i is None else i for i in self.ids], "<i8")
        null = np.array([i is None for i in self.ids], np.uint8)
        return ids.tobytes() + null.tobytes() + np.array(self.sizes, "<i8").tobytes()


# ---------------------------------------------------------------- plain ids


def _plain_type(vocabulary: int, end_id: int) -> str:
    return "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"


def _put_plain(root: str, tokenizer: str, end_id: int):
    """Rows (shard, doc_id, text) in order to one plain file a shard."""

    def run(batches):
        fs, base = file_system(root)
        enc = encoder(tokenizer)
        plain = _plain_type(enc.library.get_vocab_size(), end_id)
        shard = out = index = None
        counts = np.zeros(0, np.int64)

        def close():
            tail = index.bytes()
            out.write(tail)
            out.write(np.array([len(index.ids)], "<u8").tobytes())
            out.close()
            some = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([temp]), pa.array([len(index.ids)], pa.int64()), pa.array([sum(index.sizes)], pa.int64()),
                 pa.array([some.astype(np.int32)], pa.list_(pa.int32())), pa.array([counts[some]], pa.list_(pa.int64()))],
                ["shard", "temp", "n_docs", "n_ids", "ids", "counts"],
            )

        for b in batches:
            shards = b.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if shards[lo] != shard:
                    if shard is not None:
                        yield close()
                    shard, index, counts = int(shards[lo]), _Index(), np.zeros(1 << 16, np.int64)
                    temp = f"_plain/{shard:08d}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(f"{base}/{temp}", compression="zstd")
                for part in textvec.slices([b.slice(lo, hi - lo)], 2):
                    ids, bounds = enc.column(part.column(2))
                    flat = np.insert(ids, bounds[1:], end_id)
                    out.write(flat.astype(plain).tobytes())
                    more = np.bincount(flat, minlength=len(counts))
                    if len(more) > len(counts):
                        counts = np.pad(counts, (0, len(more) - len(counts)))
                    counts += more
                    index.ids += part.column(1).to_pylist()
                    index.sizes += (np.diff(bounds) + 1).tolist()
        if shard is not None:
            yield close()

    return run


# ---------------------------------------------------------------- files


def _write_files(root: str, ranks_of, plain: str):
    """A plain file to a ranked one."""

    def run(batches):
        fs, base = file_system(root)
        rank = np.frombuffer(ranks_of.value, "<u4")
        for b in batches:
            for row in b.to_pylist():
                temp = f"_temp/{row['shard']:08d}-{uuid.uuid4().hex}"
                size = len(MAGIC)
                with fs.open_input_stream(f"{base}/{row['temp']}", compression="zstd") as src, fs.open_output_stream(f"{base}/{temp}") as out:
                    out.write(MAGIC)
                    left = row["n_ids"]
                    while left:
                        n = min(BLOCK, left)
                        control, data = encode_block(rank[np.frombuffer(src.read(np.dtype(plain).itemsize * n), plain)])
                        out.write(np.array([n, len(data)], "<u4").tobytes())
                        out.write(control)
                        out.write(data)
                        size += 8 + len(control) + len(data)
                        left -= n
                    index = src.read(17 * row["n_docs"])
                    out.write(index)
                    tail = np.array([row["n_docs"], row["n_ids"], size], "<u8").tobytes() + MAGIC
                    out.write(tail)
                    size += len(index) + len(tail)
                yield pa.RecordBatch.from_pylist(
                    [{"shard": row["shard"], "temp": temp, "name": f"ids-{row['shard']:08d}.bin", "n_docs": row["n_docs"], "n_ids": row["n_ids"], "n_bytes": size}],
                    schema=pa.schema([("shard", pa.int32()), ("temp", pa.string()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]),
                )

    return run


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, root: str) -> DataFrame:
    """Write the files under ``root`` (a folder of the shared store); returns the manifest."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.call_function("shiftright", F.xxhash64("text"), F.lit(64 - TIE_BITS)) + F.lit(1 << TIE_BITS - 1)  # rises with the hash
    shard, n = range_shards(docs, "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)) + 64, SHARD_BYTES, tie)
    fs, base = file_system(root)
    for d in ("_plain", "_temp"):
        fs.create_dir(f"{base}/{d}")
    dealt = docs.withColumn("shard", shard).repartition(max(1, n), "shard").sortWithinPartitions("shard", "doc_id", F.xxhash64("text"))
    plain = stored(dealt.select("shard", "doc_id", "text").mapInArrow(_put_plain(root, tokenizer, end_id), _PLAIN), "ids-plain")
    pairs = plain.select(F.explode(F.arrays_zip("ids", "counts")).alias("x")).select("x.ids", "x.counts")
    counts = pairs.groupBy("ids").agg(F.sum("counts").alias("n")).collect()  # a row for each id of the vocabulary that occurs
    by_rank = np.array([r["ids"] for r in sorted(counts, key=lambda r: (-r["n"], r["ids"]))], "<u4")
    with fs.open_output_stream(f"{base}/ranks.bin") as out:
        out.write(by_rank.tobytes())
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
    rank[by_rank] = np.arange(len(by_rank))
    sent = spark.sparkContext.broadcast(rank.tobytes())
    plain_type = _plain_type(encoder(tokenizer).library.get_vocab_size(), end_id)
    files = plain.select("shard", "temp", "n_docs", "n_ids").repartition(max(1, n), "shard").mapInArrow(_write_files(root, sent, plain_type), _FILES)
    manifest = commit_files(stored(files, "ids-manifest"), root)
    fs.delete_dir(f"{base}/_plain")
    return manifest


def _read(root: str):
    def run(batches):
        fs, base = file_system(root)
        by_rank = None
        for b in batches:
            for row in b.to_pylist():
                if by_rank is None:
                    with fs.open_input_stream(f"{base}/ranks.bin") as f:
                        by_rank = np.frombuffer(f.read(), "<u4")
                with fs.open_input_file(f"{base}/{row['name']}") as f:
                    yield from _file_rows(f, by_rank, row["start"])

    return run


def _file_rows(f: io.RawIOBase, by_rank: np.ndarray, start: int):
    size = f.size()
    f.seek(size - 32)
    tail = f.read(32)
    n, total, at = (int(x) for x in np.frombuffer(tail[:24], "<u8"))
    if tail[24:] != MAGIC:
        raise ValueError("not a complete id file")
    f.seek(at)
    doc_ids = np.frombuffer(f.read(8 * n), "<i8")
    null = np.frombuffer(f.read(n), np.uint8).astype(bool)
    sizes = np.frombuffer(f.read(8 * n), "<i8")
    f.seek(0)
    if f.read(8) != MAGIC:
        raise ValueError("not an id file")
    ends = np.cumsum(sizes)
    crc = np.zeros(n, np.int64)
    done, doc, running = 0, 0, 0
    while done < total:
        ids, data = (int(x) for x in np.frombuffer(f.read(8), "<u4"))
        control = f.read(-(-ids // 4))
        raw = memoryview(by_rank[decode_block(control, f.read(data), ids)].astype("<u4").tobytes())
        pos = 0
        while pos < ids:
            take = min(ids - pos, int(ends[doc]) - done - pos)
            running = zlib.crc32(raw[4 * pos : 4 * (pos + take)], running)
            pos += take
            if done + pos == ends[doc]:
                crc[doc], running = running, 0
                doc += 1
        done += ids
    for lo in range(0, n, 10_000):
        hi = min(n, lo + 10_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids[lo:hi], mask=null[lo:hi]), pa.array(start + ends[lo:hi] - sizes[lo:hi]), pa.array(sizes[lo:hi]), pa.array(crc[lo:hi])],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_ids(manifest: DataFrame, root: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document of the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = manifest.select("shard", "name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    return files.repartition(max(1, manifest.count()), "shard").mapInArrow(_read(root), "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_root(spark: SparkSession) -> str:
    return fresh_dir(spark, "ids")
