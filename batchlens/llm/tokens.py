"""Token counts, with overlap resynchronisation for huge documents.

A text longer than CHUNK characters is encoded in overlapping chunks, with token offsets. Two neighbouring chunks are
spliced at a *stable boundary*: a character position that starts a token in both chunks, where both chunks go on with the
same tokens, and at which no token of the whole text can lie across, whatever stands left or right of it. The last
part is proven by the characters at the boundary: the tokenizer's pre-tokens never hold white space or span the edge of an
ASCII digit, its normalisation does not join characters over these places, and its special strings hold neither. Where no such
boundary lies in the overlap, the overlap is doubled, up to the whole rest of the text.

Texts up to CHUNK characters are cut after ASCII white space and between ASCII letters and signs, which are stable boundaries too, and
the parts' ids come from a table in front of the library, kept by the worker process: parts are hashed and looked up a whole
column at a time with numpy, and only those not seen yet are encoded. Texts with special strings go to the library whole.

The same encoder feeds ``idfiles``. Tokens are the library's: no added begin or end, special strings inside texts as its
default has them, no truncation or padding.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm import textvec

CHUNK = 16384
OVERLAP = 512
#: Parts kept by a worker's table; it starts anew when full.
TABLE_PARTS = 1_000_000
AGREE = 3  # tokens that must agree after a boundary

#: Bytes as the tokenizer's lower-casing leaves them, white space 0.
_FOLD = textvec.fold_table()
#: 2 ASCII letters, 3 ASCII signs but the apostrophe (contractions hold one), 1 all else.
_PARTS = np.ones(256, np.uint8)
_PARTS[list(textvec.SPACE)] = 0
_PARTS[[*range(65, 91), *range(97, 123)]] = 2
_PARTS[[c for c in (*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)) if c != 0x27]] = 3

_loaded: dict = {}


def encoder(path: str) -> "Encoder":
    """One encoder a worker process and file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def stable(text: str, p: int) -> bool:
    """Whether no token can lie across position p of the text, by the two characters there alone."""
    a, b = text[p - 1], text[p]
    if not (a.isascii() and b.isascii()):
        return a in " \n"
    return a in " \n\t\r" or a.isdigit() or b.isdigit()


class Table:
    """Ids of word parts by their 64-bit hash and a second check of length, first and last bytes."""

    SLOTS = 1 << 22

    def __init__(self):
        self.slot = np.full(self.SLOTS, -1, np.int32)  # by the hash's low bits; parts that share a slot are found by search
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.count = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.order, self.sorted = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Place of every part, -1 for those that are not here."""
        at = self.slot[(keys & np.uint64(self.SLOTS - 1)).astype(np.int64)]
        if not len(self.keys):
            return at
        miss = np.flatnonzero((self.keys[at] != keys) | (self.checks[at] != checks) | (at < 0))
        if len(miss):
            near = np.minimum(np.searchsorted(self.sorted, keys[miss]), len(self.sorted) - 1)
            place = self.order[near]
            good = (self.keys[place] == keys[miss]) & (self.checks[place] == checks[miss])
            at[miss] = np.where(good, place, -1)
        return at

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.keys)
        self.keys, self.checks = np.concatenate((self.keys, keys)), np.concatenate((self.checks, checks))
        self.count = np.concatenate((self.count, counts))
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(counts)))
        self.pool = np.concatenate((self.pool, ids))
        self.slot[(keys & np.uint64(self.SLOTS - 1)).astype(np.int64)] = np.arange(n, n + len(keys), dtype=np.int32)

    def ids(self, at: np.ndarray) -> np.ndarray:
        """The ids of these parts, one after the other."""
        n = self.count[at]
        ends = np.cumsum(n)
        return self.pool[np.repeat(self.start[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]

    def index(self) -> None:
        self.order = np.argsort(self.keys)
        self.sorted = self.keys[self.order]


def ends_check(w: textvec.Words, ignore: int = 0) -> np.ndarray:
    """A second check of every word: its length, first and last eight bytes, less the bits to ignore."""
    if not len(w.hash):
        return np.zeros(0, np.uint64)
    size = (w.end - w.start).astype(np.uint64)
    padded = np.concatenate((w.data[w.offsets[0] : w.offsets[-1]], np.zeros(8, np.uint8)))
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the 8 bytes from every byte on
    lo = w.start - w.offsets[0]
    mask = np.where(size >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (np.minimum(size, 7) * np.uint64(8))) - np.uint64(1))
    last = eight[np.maximum(w.end - w.offsets[0] - 8, lo)] & mask
    return textvec.mix(((eight[lo] & mask) | np.uint64(ignore)) + size) ^ (last | np.uint64(ignore))


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers

        self.library, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        (self.cut,) = self.library.encode("0", add_special_tokens=False).ids
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.table = Table()

    # ------------------------------------------------------------ huge texts

    def _chunk(self, text: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and start positions (in the whole text) of the tokens of text[lo:hi]."""
        e = self.library.encode(text[lo:hi], add_special_tokens=False)
        starts = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.offsets)) + lo
        return np.array(e.ids, np.int64), starts

    @staticmethod
    def _splice(text: str, left, right, lo: int, hi: int) -> int | None:
        """A stable boundary in lo..hi that both encodings agree on, nearest the middle."""
        common = np.intersect1d(left[1], right[1])
        common = common[(common > lo) & (common < hi)]
        for p in sorted(common.tolist(), key=lambda x: abs(x - (lo + hi) // 2)):
            i, j = np.searchsorted(left[1], p), np.searchsorted(right[1], p)
            n = min(AGREE, len(left[0]) - i - 1)  # the left chunk's last token may be cut
            if stable(text, p) and n > 0 and (left[0][i : i + n] == right[0][j : j + n]).all():
                return p
        return None

    def long(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
        """Token ids of a text, through chunks."""
        out, done, lo = [], 0, 0
        hi = min(len(text), chunk)
        left = self._chunk(text, lo, hi)
        while hi < len(text):
            width = overlap
            while True:
                start = max(lo, hi - width)
                end = min(len(text), start + max(chunk, 2 * width))
                right = self._chunk(text, start, end)
                p = self._splice(text, left, right, max(start, done), hi)
                if p is not None:
                    break
                if start == lo and end == len(text):
                    p = done  # nothing fits: the rest is encoded as one
                    break
                width *= 2
            if p == done and start == lo:
                keep = right[1] >= done
                return np.concatenate([*out, right[0][keep]])
            mine = (left[1] >= done) & (left[1] < p)
            out.append(left[0][mine])
            done, lo, hi, left = p, p, end, (right[0][right[1] >= p], right[1][right[1] >= p])
        out.append(left[0][left[1] >= done])
        return np.concatenate(out)

    # ------------------------------------------------------------ columns of texts

    def _learn(self, w: textvec.Words, which: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> None:
        """Encode the parts at these places, joined by a digit whose token then cuts the ids apart. ASCII parts in lower case need no
        normalisation; parts that hold the digit go alone."""
        data = w.data[w.offsets[0] : w.offsets[-1]].tobytes()
        base = int(w.offsets[0])
        words = [data[a:b] for a, b in zip((w.start[which] - base).tolist(), (w.end[which] - base).tolist())]
        kinds = np.array([2 if b"0" in x else 0 if x.isascii() else 1 for x in words])
        for kind, library in ((0, self.bare), (1, self.library)):
            pick = np.flatnonzero(kinds == kind)
            if not len(pick):
                continue
            texts = [b" 0 ".join([words[i] for i in pick[at : at + 1000]]) + b" 0" for at in range(0, len(pick), 1000)]
            texts = [(t.lower() if kind == 0 else t).decode() for t in texts]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in library.encode_batch_fast(texts, add_special_tokens=False)])
            ends = np.flatnonzero(ids == self.cut)
            if len(ends) != len(pick):
                raise ValueError("the cutting digit's token is not its own")
            self.table.add(keys[which[pick]], checks[which[pick]], ids[ids != self.cut], np.diff(ends, prepend=-1) - 1)
        pick = np.flatnonzero(kinds == 2)
        if len(pick):
            lists = [e.ids for e in self.library.encode_batch_fast([words[i].decode() for i in pick], add_special_tokens=False)]
            self.table.add(keys[which[pick]], checks[which[pick]], np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists]))
        self.table.index()

    def _parts(self, column) -> tuple[textvec.Words, np.ndarray]:
        """The column's word parts and their places in the table."""
        w = textvec.words(column, _FOLD, parts=_PARTS)
        if not len(w.hash):
            return w, np.zeros(0, np.int64)
        # letters in either case are one part: bit 5 is left out (the hash tells other bytes apart)
        checks = ends_check(w, 0x2020202020202020)
        if len(self.table.keys) > TABLE_PARTS:
            self.table = Table()
        keys = textvec.mix(w.hash + checks)
        at = self.table.find(keys, checks)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            _, first = np.unique(keys[miss], return_index=True)
            self._learn(w, miss[first], keys, checks)
            at[miss] = self.table.find(keys[miss], checks[miss])
            if (at < 0).any():
                raise ValueError("two word parts share their hash")
        return w, at

    def _whole(self, column) -> list[int]:
        """Texts that hold a special string."""
        data = column.cast(pa.large_string())
        hit = np.zeros(len(column), bool)
        for s in self.special:
            hit |= pc.match_substring(data, s).fill_null(False).to_numpy(zero_copy_only=False)
        return np.flatnonzero(hit).tolist()

    def column(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds): the ids of text i are ids[bounds[i]:bounds[i + 1]]. Nulls are empty."""
        w, at = self._parts(column)
        n = self.table.count[at]
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = self.table.ids(at)
        bounds = ends[w.bounds]
        whole = self._whole(column)
        if whole:
            own = {i: np.array(self.library.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32) for i in whole}
            texts = [own[i] if i in own else ids[a:b] for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]
            ids, bounds = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        return ids, bounds

    def counts(self, column) -> np.ndarray:
        """Number of tokens of every text: huge texts through chunks, others through the table."""
        size = pc.utf8_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        huge = size > CHUNK
        short = pc.if_else(pa.array(huge), pa.scalar("", column.type), column.fill_null(""))
        w, at = self._parts(short)
        n = np.diff(np.concatenate(([0], np.cumsum(self.table.count[at])))[w.bounds])
        for i in self._whole(short):
            n[i] = len(self.library.encode(short[i].as_py(), add_special_tokens=False).ids)
        for i in np.flatnonzero(huge):
            n[i] = len(self.long(column[int(i)].as_py()))
        return n


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. A null text is empty: 0 bytes, 0 tokens. Rows with a null or
    repeated doc_id are counted each; an empty table gives an empty one; other columns are not looked at."""

    def run(batches):
        enc = encoder(tokenizer)
        for b in textvec.slices(batches, 1):
            n = enc.counts(b.column(1))
            size = np.diff(textvec.text_bytes(b.column(1))[1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, out)
