"""Benchmark decontamination with spaced seeds.

Words are lower-cased runs between white space and ASCII punctuation. A seed is the hash of the words at a mask's places in a window;
the places the mask leaves out may differ, so a passage with some words replaced still shares seeds with its source.
Seeds of all benchmark items go into a Bloom filter of fixed size; only document windows that pass it are joined, by seed,
with the benchmark's. A hit gives a diagonal (document place minus item place), and the words of document and item are
compared along it: a document holds an item if of RUN consecutive words (of the whole item, if that is shorter) at
least SHARE are equal at the same places. The masks hit every such run of RUN words and every such item of 8 words or more; items of 5 to 7
words, of which one may differ, have short masks of their own.

Defined results: items with fewer than five words, and null or empty texts, match nothing; identical items count as the
one with the smallest id; an item is reported once for each document, with its longest overlap (ties: the first); rows
with a null doc_id are reported under null; repeated rows are reported once; empty tables give empty results; other columns
are not looked at. Texts are searched whole; no hit is dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm import textvec
from batchlens.llm.shared import bloom, bloom_mask, small_batches, stored

#: Places of a window that a seed looks at. The first tolerates nothing within it; the others skip places.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 7), (0, 1, 4, 6, 7), (0, 3, 4, 5, 8), (0, 1, 2, 5, 6))
#: Masks that are seeded from items of fewer than SHORT words only; documents are searched with them if there are such items.
SHORT = 8
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4))
ALL_MASKS = MASKS + SHORT_MASKS
RUN = 13
SHARE = 0.8

#: White space and ASCII punctuation.
_BREAKS = (*textvec.SPACE, *range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F))
WORDS = textvec.fold_table(_BREAKS)

_HITS = "key long, doc_id long, seed long, place int"


def _seeds(h: np.ndarray, mask: int) -> np.ndarray:
    take = ALL_MASKS[mask]
    return textvec.sequences(h, take[-1] + 1, take) ^ textvec.constants(len(ALL_MASKS), 99)[mask]


def _item_masks(words: int) -> range:
    return range(0 if words < 5 else len(ALL_MASKS) if words < SHORT else len(MASKS))


def _word_rows(batches):
    """(id, key, text) to (id, key, word hashes)."""
    for b in textvec.slices(batches, 2):
        w = textvec.words(b.column(2), WORDS)
        lists = pa.LargeListArray.from_arrays(pa.array(w.bounds.astype(np.int64)), pa.array(w.hash.view(np.int64))).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["id", "key", "words"])


def _item_seeds(batches):
    for b in batches:
        for item, words in zip(b.column(0).to_pylist(), b.column(1)):
            h = np.asarray(words.values, np.int64).view(np.uint64)
            for m in _item_masks(len(h)):
                s = _seeds(h, m)
                if len(s):
                    yield pa.RecordBatch.from_pydict(
                        {"seed": s.view(np.int64), "item_id": np.full(len(s), item), "item_place": np.arange(len(s), dtype=np.int32)}
                    )


def _document_hits(filter_bits, masks):
    """(doc_id, key, text) to the seeds of these masks that pass the filter."""

    def run(batches):
        bits = np.frombuffer(filter_bits.value, np.uint8)
        for b in textvec.slices(batches, 2):
            w = textvec.words(b.column(2), WORDS)
            ids, keys = b.column(0), b.column(1)
            for m, take in enumerate(masks):
                s = _seeds(w.hash, m)  # over the whole column; windows that run over a text's end are left out below
                at = np.flatnonzero(bloom_mask(bits, s))
                text = np.searchsorted(w.bounds, at, "right") - 1
                inside = at + take[-1] < w.bounds[text + 1]
                at, text = at[inside], text[inside]
                if len(at):
                    rows = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(rows), ids.take(rows), pa.array(s[at].view(np.int64)), pa.array((at - w.bounds[text]).astype(np.int32))],
                        ["key", "doc_id", "seed", "place"],
                    )

    return run


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Along doc place = item place + shift: (first word, words, equal words) of the longest overlap, or none."""
    run = min(RUN, len(item))
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if hi - lo < run:
        return None
    same = (item[lo:hi] == doc[lo + shift : hi + shift]).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(sums[run:] - sums[:-run] >= math.ceil(SHARE * run))
    if not len(good):
        return None
    groups = np.split(good, np.flatnonzero(np.diff(good) > run) + 1)
    best = max(groups, key=lambda g: g[-1] - g[0])
    a, b = int(best[0]), int(best[-1]) + run
    return lo + shift + a, b - a, int(sums[b] - sums[a])


def _verify(batches):
    for b in batches:
        out = []
        docs, items = b.column("words"), b.column("item_words")
        for i, (doc_id, item_id, shift) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("item_id").to_pylist(), b.column("shift").to_pylist())):
            found = overlap(np.asarray(docs[i].values), np.asarray(items[i].values), shift)
            if found:
                out.append((doc_id, item_id, *found))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *[pa.array(c, pa.int32()) for c in cols[2:]]],
                ["doc_id", "item_id", "start_word", "n_words", "n_equal"],
            )


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, n_words, n_equal: the documents that hold benchmark passages."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string"))
    raw = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("key"), F.col("text").cast("string"))
    items = raw.mapInArrow(_word_rows, "id long, key long, words array<long>")
    items = stored(items.groupBy("words").agg(F.min("id").alias("item_id")).select("item_id", F.col("words").alias("item_words")), "benchmark-items")
    seeds = stored(items.mapInArrow(_item_seeds, "seed long, item_id long, item_place int"), "benchmark-seeds")
    bits = spark.sparkContext.broadcast(bloom(seeds, F.col("seed")))  # 2 MB whatever the benchmark's size
    short = not items.where((F.size("item_words") >= 5) & (F.size("item_words") < SHORT)).isEmpty()
    hits = texts.mapInArrow(_document_hits(bits, ALL_MASKS if short else MASKS), _HITS)
    diagonals = stored(
        hits.join(seeds, "seed").select("key", "doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).distinct(),
        "benchmark-hits",
    )
    wanted = spark.sparkContext.broadcast(bloom(diagonals.select("key").distinct(), F.col("key")))

    def hit_texts(batches):
        keep = np.frombuffer(wanted.value, np.uint8)
        for b in batches:
            mask = bloom_mask(keep, np.asarray(b.column(1)).view(np.uint64))
            if mask.any():
                yield b.filter(pa.array(mask))

    words = texts.mapInArrow(lambda batches: _word_rows(hit_texts(batches)), "id long, key long, words array<long>").select("key", "words")
    pairs = diagonals.join(items, "item_id").join(words, "key").select("doc_id", "item_id", "shift", "item_words", "words")
    found = pairs.mapInArrow(_verify, "doc_id long, item_id long, start_word int, n_words int, n_equal int")
    best = F.max_by(F.struct("start_word", "n_words", "n_equal"), F.struct("n_words", "n_equal", -F.col("start_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, unchanged."""
    hit = find_overlaps(docs, benchmark).select(F.col("doc_id").alias("hit_id")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id"]), "left_anti")
