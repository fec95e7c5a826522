"""Line dedup by pairwise alignment.

A line is what stands between line breaks; lines without a word are passed over. A *run* is a shortest stretch of consecutive lines
with at least MIN_WORDS words; its hash is the rare line hash that finds partners: a text that shares MIN_WORDS or more
words of whole lines with an earlier one shares such a run. Every run's first holder (smallest doc_id) is known from
one aggregation, and each later holder is paired with it: a run in n documents gives n - 1 pairs. A pair is aligned
with patience diff: lines that occur once on either side anchor the longest increasing chain, which grows over equal
neighbours, and the gaps are aligned again. What is left over on both sides is aligned once more until nothing is found, so that blocks in another
order are found too. Common blocks of at least MIN_WORDS words, and further copies of them, are deleted from the later document.

A deleted line always remains in an earlier document, as the first holder of a run never loses it on that run's account.

Defined results: null texts stay null and empty texts empty; lines are compared byte for byte; documents are ordered by doc_id,
nulls first, then by a hash of the text; rows equal in doc_id and text count as one document and are kept or cut alike;
lines repeated only within one document stay; an empty table gives an empty one; all columns are carried through.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlens.llm import textvec
from batchlens.llm.shared import small_batches, stored

MIN_WORDS = 30

_KEY = "id long, key long"
_LINES = f"{_KEY}, lines array<long>, n_words array<int>, runs array<long>"


# ---------------------------------------------------------------- alignment


def _chain(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    back = []
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        if k == len(tails):
            tails.append(p)
            at.append(i)
        else:
            tails[k], at[k] = p, i
        back.append(at[k - 1] if k else -1)
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places (i in a, j in b), both rising."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        where: dict[int, int] = {}
        for i in range(a0, a1):
            where[a[i]] = -1 if a[i] in where else i
        seen: dict[int, int] = {}
        for j in range(b0, b1):
            seen[b[j]] = -1 if b[j] in seen else j
        pairs = [(where[h], j) for h, j in seen.items() if j >= 0 and where.get(h, -1) >= 0]
        pairs.sort(key=lambda p: p[1])
        anchors = [pairs[k] for k in _chain([i for i, _ in pairs])]
        if not anchors:  # only repeated lines in common: anchor the first that fits
            found = next(((where_first(a, a0, a1, b[j]), j) for j in range(b0, b1) if b[j] in where), None)
            if found is None:
                continue
            anchors = [found]
        pa_, pb = a0, b0
        for i, j in anchors:
            todo.append((pa_, i, pb, j))
            out.append((i, j))
            pa_, pb = i + 1, j + 1
        todo.append((pa_, a1, pb, b1))
    return sorted(out)


def where_first(a: list[int], lo: int, hi: int, h: int) -> int:
    return next(i for i in range(lo, hi) if a[i] == h)


def common_lines(a: list[int], b: list[int], n_words: list[int], least: int = MIN_WORDS) -> list[int]:
    """Places in b of the lines in common blocks of at least ``least`` words, and of further copies of such blocks in b."""
    gone: set[int] = set()
    left_a, left_b = list(range(len(a))), list(range(len(b)))
    places: dict[int, list[int]] = {}
    for j, h in enumerate(b):
        places.setdefault(h, []).append(j)
    while matched := [(left_a[i], left_b[j]) for i, j in patience([a[i] for i in left_a], [b[j] for j in left_b])]:
        blocks: list[list[tuple[int, int]]] = []
        for m in matched:
            if blocks and m == (blocks[-1][-1][0] + 1, blocks[-1][-1][1] + 1):
                blocks[-1].append(m)
            else:
                blocks.append([m])
        for block in blocks:
            at, n = block[0][1], len(block)
            if sum(n_words[at : at + n]) >= least:
                for j in places[b[at]]:
                    if b[j : j + n] == b[at : at + n] and gone.isdisjoint(range(j, j + n)):
                        gone.update(range(j, j + n))
        used_a, used_b = {i for i, _ in matched}, gone | {j for _, j in matched}
        left_a = [i for i in left_a if i not in used_a]
        left_b = [j for j in left_b if j not in used_b]
    count = dict(zip(b, n_words))
    known = {tuple(a[i:e]) for i, e in _runs([count.get(h, least) for h in a], least)}  # lines that b lacks end no run of b's
    for j, e in _runs(n_words, least):  # a run whose lines were matched elsewhere one by one
        if tuple(b[j:e]) in known:
            gone.update(range(j, e))
    return sorted(gone)


def _runs(n_words: list[int], least: int):
    """(start, end) of the shortest run of at least ``least`` words from each line on."""
    end = total = 0
    for start, n in enumerate(n_words):
        while total < least and end < len(n_words):
            total += n_words[end]
            end += 1
        if total < least:
            return
        yield start, end
        total -= n


# ---------------------------------------------------------------- lines of texts


def _line_rows(least: int):
    def run(batches):
        for b in textvec.slices(batches, 2):
            lines = textvec.words(b.column(2), textvec.LINES)
            words = textvec.words(b.column(2), textvec.WORDS)
            n = np.searchsorted(words.start, lines.end) - np.searchsorted(words.start, lines.start)
            full = n > 0
            kept = np.concatenate(([0], np.cumsum(full)))
            bounds = kept[lines.bounds]
            h, n = lines.hash[full], n[full]
            sums = np.concatenate(([0], np.cumsum(n)))
            # the last line of the run that starts at each line; runs do not leave their text
            last = np.searchsorted(sums, sums[:-1] + least) - 1
            text_end = np.repeat(bounds[1:], np.diff(bounds))
            whole = last < text_end
            c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(len(h)), dtype=np.uint64)))
            at = np.flatnonzero(whole)
            run_hash = textvec.mix((c[last[at] + 1] - c[at]) * _inverse(len(h))[at] + (last[at] - at).astype(np.uint64))
            run_bounds = np.concatenate(([0], np.cumsum(whole)))[bounds]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(1),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(n.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(run_bounds.astype(np.int32)), pa.array(run_hash.view(np.int64))),
                ],
                ["id", "key", "lines", "n_words", "runs"],
            )

    return run


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(max(n, 1), 0xD6E8FEB86659FD93, np.uint64))[:n]


def _inverse(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(max(n, 1), pow(0xD6E8FEB86659FD93, -1, 1 << 64), np.uint64))[:n]


def _align(least: int):
    def run(batches):
        for b in batches:
            out = [common_lines(a, c, n, least) for a, c, n in zip(b.column("first_lines").to_pylist(), b.column("lines").to_pylist(), b.column("n_words").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(out, pa.list_(pa.int32()))], ["id", "key", "gone"])

    return run


def find_repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """id, key, gone (places, among the lines with words, to delete) of the documents that repeat earlier ones."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), _key().alias("key"), F.col("text").cast("string"))
    lines = stored(texts.mapInArrow(_line_rows(least), _LINES).where(F.size("lines") > 0), "lines")
    own = F.struct("id", "key")
    runs = lines.select(own.alias("doc"), F.explode(F.array_distinct("runs")).alias("run"))
    first = runs.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where(F.col("first") != F.col("last"))
    pairs = runs.join(first, "run").where(F.col("doc") != F.col("first")).select("doc", "first").distinct()
    cut = lines.select(own.alias("doc"), "lines", "n_words").dropDuplicates(["doc"])
    both = (
        pairs.join(cut, "doc")
        .join(cut.select(F.col("doc").alias("first"), F.col("lines").alias("first_lines")), "first")
        .select("doc.id", "doc.key", "lines", "n_words", "first_lines")
    )
    gone = both.mapInArrow(_align(least), f"{_KEY}, gone array<int>")
    return gone.groupBy("id", "key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def _key():
    return F.xxhash64("text")


def _cut(names: list[str], mark: str):
    """Delete the lines that column ``mark`` has from ``text``; adds n_lines and n_deleted."""

    def run(batches):
        for b in textvec.slices(batches, names.index("text")):
            col = b.column("text")
            lines = textvec.words(col, textvec.LINES)
            spaces = textvec.words(col, textvec.WORDS)
            n = np.searchsorted(spaces.start, lines.end) - np.searchsorted(spaces.start, lines.start)
            gone_col = b.column(mark).to_pylist()
            texts, n_lines, n_deleted = [], [], []
            for i, gone in enumerate(gone_col):
                a, z = int(lines.bounds[i]), int(lines.bounds[i + 1])
                full = np.flatnonzero(n[a:z]) + a
                n_lines.append(len(full))
                n_deleted.append(len(gone or ()))
                if not gone:
                    texts.append(col[i].as_py())
                    continue
                lo, hi = int(lines.offsets[i]), int(lines.offsets[i + 1])
                at, out = lo, []
                for k in full[np.array(gone)]:
                    out.append(lines.data[at : lines.start[k]].tobytes())
                    at = int(lines.end[k])
                    if at < hi and lines.data[at] == 13:
                        at += 1
                    if at < hi and lines.data[at] == 10:
                        at += 1
                out.append(lines.data[at:hi].tobytes())
                texts.append(b"".join(out).decode("utf-8", "replace"))
            cols = {name: b.column(name) for name in names} | {"text": pa.array(texts, pa.string()), "n_lines": pa.array(n_lines, pa.int32()), "n_deleted": pa.array(n_deleted, pa.int32())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """All rows and columns with the repeated blocks deleted from ``text``, and n_lines (lines with words), n_deleted.
    Columns of these two names in the input are replaced."""
    docs = docs.drop("n_lines", "n_deleted")
    gone = find_repeats(docs, least).select(F.col("id").alias("gone_id"), F.col("key").alias("gone_key"), F.col("gone").alias("gone_lines"))
    on = docs["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_key"])
    mark = "gone"
    while mark in docs.columns:
        mark += "_"
    ready = docs.join(gone, on, "left").select(*[docs[c] for c in docs.columns], F.col("gone_lines").alias(mark))
    more = [T.StructField(c, T.IntegerType()) for c in ("n_lines", "n_deleted")]
    return ready.mapInArrow(_cut(docs.columns, mark), T.StructType(docs.schema.fields + more))
