"""Near-duplicate groups by SimHash fingerprints and pigeonhole blocks.

- A fingerprint has 64 bits: bit i is 1 if more than half of the text's 3-word shingles (repeats included) have it in their
  XXH64 (seed 42). Texts are hashed in pieces of about CHUNK bytes, so memory is bounded for texts of any length.
- Rows with equal fingerprints are one row from then on, whatever their number.
- Fingerprints that differ in at most DISTANCE bits agree on at least one of DISTANCE + 1 blocks of bits. So every fingerprint is put
  into one bucket for each block (its bits there), and only buckets are compared. A bucket of more than LEAF fingerprints is divided
  by the same principle: its close pairs agree on one of DISTANCE + 1 blocks of the bits that are still free. This goes on until buckets are
  small or LAST bits are free, which bounds a bucket by 2 ** LAST fingerprints; no bucket, fingerprint or pair is left out.
- In a bucket all pairs are verified by Hamming distance, and only links that join two groups of the bucket leave it: fewer than
  it has fingerprints.
- Links become components of documents.

Defined results: null and empty texts, and texts without words, have fingerprint zero and are linked like any other; texts of one or two
words are one shingle; rows with one doc_id are one node, whatever their texts; a null doc_id takes no part (component_id null); an empty
table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm import textvec
from batchlens.llm.neardup import components
from batchlens.llm.shared import stored

WIDTH = 3
SEED = 42
BITS = 64
DISTANCE = 3
#: Fingerprints of a bucket that are compared at once; larger buckets are divided.
LEAF = 512
#: Free bits at which a bucket is not divided any more.
LAST = 12
#: Tasks over which the rows of one large bucket are spread until it is divided.
SALTS = 64
CHUNK = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ---------------------------------------------------------------- fingerprints


def _shingle_hashes(text: bytes):
    """Arrays of the XXH64 of every shingle of a text, a piece of the text at a time."""
    at, kept, seen = 0, [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + CHUNK)
        end = cut.start() if cut else len(text)
        words = kept + text[at:end].lower().split()  # bytes: only A-Z, only the six separators
        at = end
        if len(words) >= WIDTH:
            line = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            starts = (ends - sizes).tolist()
            hashes = [xxhash.xxh64_intdigest(line[a:z], SEED) for a, z in zip(starts, ends[WIDTH - 1 :].tolist())]
            yield np.array(hashes, np.uint64)
            seen += 1
        kept = words[-(WIDTH - 1) :]
    if not seen and kept:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)], np.uint64)


def fingerprint(text: bytes) -> int:
    total, ones = 0, np.zeros(BITS, np.int64)
    for h in _shingle_hashes(text):
        total += len(h)
        for lo in range(0, len(h), 65536):
            part = h[lo : lo + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def _fingerprints(batches):
    for b in textvec.slices(batches, 1):
        texts = b.column(1).cast(pa.large_binary()).fill_null(b"")
        fp = np.array([fingerprint(t.as_py()) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_fingerprints, "doc_id long, fp long")


# ---------------------------------------------------------------- blocks


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def blocks_of(mask: int) -> list[int]:
    """The mask (bits on which a bucket agrees) with one of DISTANCE + 1 blocks of its free bits added, for each block."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    cuts = [len(free) * k // (DISTANCE + 1) for k in range(DISTANCE + 2)]
    return [mask | sum(1 << k for k in free[a:z]) for a, z in zip(cuts, cuts[1:])]


def _divide(batches):
    """mask, fp of large buckets to the rows of their blocks."""
    for b in batches:
        masks, fps = b.column(0).to_numpy(), b.column(1).to_numpy()
        for m in np.unique(masks).tolist():
            some = fps[masks == m]
            for child in blocks_of(m & (1 << BITS) - 1):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), _signed(child))), pa.array(some)], ["mask", "fp"])


def _roots(up: np.ndarray) -> np.ndarray:
    while True:
        further = up[up]
        if np.array_equal(further, up):
            return up
        up = further


def bucket_links(bucket: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (places i, j) that join the close fingerprints of every bucket; equal numbers in ``bucket`` are one run."""
    n = len(fp)
    last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True))
    follow = np.repeat(last, np.diff(last, prepend=-1)) - np.arange(n)  # rows of its bucket that follow a row
    up = np.arange(n)
    out_i, out_j = [], []
    at = np.arange(n)
    step = 1
    while True:
        at = at[follow[at] >= step]
        if not len(at):
            break
        hit = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= DISTANCE]
        hit = hit[up[hit] != up[hit + step]]
        for i in hit.tolist():
            a, z = i, i + step
            while up[a] != a:
                a = up[a]
            while up[z] != z:
                z = up[z]
            if a != z:
                up[max(a, z)] = min(a, z)
                out_i.append(i)
                out_j.append(i + step)
        if len(hit):
            up = _roots(up)
        step += 1
    return np.array(out_i, np.int64), np.array(out_j, np.int64)


def _verify(batches):
    """mask, value, fp sorted by bucket to links (a, b)."""
    held = [np.zeros(0, np.int64)] * 3

    def links(mask, value, fp):
        change = np.append(False, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
        bits = fp.view(np.uint64)
        i, j = bucket_links(np.cumsum(change), bits)
        return pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j])], ["a", "b"])

    for b in batches:
        held = [np.concatenate([h, b.column(k).to_numpy()]) for k, h in enumerate(held)]
        mask, value, _ = held
        open_from = int(np.flatnonzero((mask != mask[-1]) | (value != value[-1]))[-1]) + 1 if ((mask != mask[-1]) | (value != value[-1])).any() else 0
        if open_from:
            yield links(*[h[:open_from] for h in held])
            held = [h[open_from:] for h in held]
    if len(held[0]):
        yield links(*held)


def close_links(fps: DataFrame) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` that join all that are within DISTANCE bits."""
    first = F.array(*[F.lit(_signed(m)) for m in blocks_of(0)])
    rows = fps.select(F.explode(first).alias("mask"), "fp")
    out = None
    while True:
        rows = rows.withColumn("value", F.col("mask").bitwiseAND(F.col("fp")))
        large = rows.groupBy("mask", "value").count().where((F.col("count") > LEAF) & (F.bit_count("mask") < BITS - LAST))
        large = stored(large.select("mask", "value"), "large-buckets")
        more = not large.isEmpty()
        if more:
            spread = large.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("large"))
            salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")
            told = stored(rows.withColumn("salt", salt).join(spread, ["mask", "value", "salt"], "left").drop("salt"), "buckets")
            rows = told.where("large is null")
        some = rows.select("mask", "value", "fp").repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(_verify, "a long, b long")
        out = some if out is None else out.unionByName(some)
        if not more:
            return out
        rows = told.where("large").select("mask", "fp").mapInArrow(_divide, "mask long, fp long")


# ---------------------------------------------------------------- components


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable) of every row."""
    rows = stored(fingerprints(docs), "fingerprints")
    known = rows.where("doc_id is not null")
    fps = stored(known.groupBy("fp").agg(F.min("doc_id").alias("label")), "fingerprints")
    # Rows that share a doc_id are one node, whatever their texts.
    twice = known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("doc_id", "a")
    same_id = known.join(twice, "doc_id").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    links = stored(close_links(fps.select("fp")).unionByName(same_id), "fingerprint-links")
    one, two = (fps.select(F.col("fp").alias(c), F.col("label").alias(n)) for c, n in (("a", "x"), ("b", "y")))
    moved = components(links.join(one, "a").join(two, "b").where("x <> y").select("x", "y").distinct())
    named = fps.join(moved, "label", "left").select("fp", F.coalesce("comp", "label").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return rows.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows whose doc_id is its component's smallest, or null; columns as they were."""
    gone = near_duplicates(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
