"""SentencePiece encoding and decoding with a shared-prefix forward pass.

White space is marked, texts are cut into marked words (no piece crosses the start of a marked word, nor a line feed, which
is checked when the model is loaded). Words are looked up a whole column at a time, by hash, in a table that the worker
process keeps, and the distinct words that are not there yet are sorted. Sorted words are the leaves of a trie in
depth-first order: two neighbours share the forward states of their common prefix, so each trie node is worked out once.

A forward state holds the best last piece of the encoding of that prefix, its start and its score. For a BPE model the best path is the one that merging
by score leads to: a sequence of pieces is a BPE encoding exactly if every piece and every two neighbours, merged on their
own, stay as they are. So among the pieces that end at a node only one is compatible with the state before it, and the
forward pass keeps that one; answers to "do these two stay apart" are remembered. The pieces that end at a node come from an
Aho-Corasick automaton over the model's pieces, whose steps are worked out as texts ask for them: one look-up a character. Words with runs of white space, whose pieces
tie in score, are merged directly. The tests hold the ids against the sentencepiece library.

Characters without a piece become byte pieces (or the unknown piece, if the model has no byte pieces).
"""

from __future__ import annotations

import heapq
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm import textvec
from batchlens.llm.shared import small_batches
from batchlens.llm.tokens import Table, ends_check

MARK = "▁"
#: Marked words and their ids kept by a worker's table (about 35 MB); it starts anew when it has more of either.
TABLE_WORDS = 400_000
TABLE_IDS = 2_500_000
#: Places for pairs of pieces whose compatibility is remembered (8 MB); a pair that falls on a taken place replaces the one there.
PAIRS = 1 << 20
_NO_PAIR = (1 << 64) - 1
#: Steps of the automaton that are remembered (about 10 MB); it forgets them all when there are more.
STEPS = 100_000
#: Bytes of text that are worked on at once.
SLICE = 1 << 19
_UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")

#: Bytes as they are, spaces 0; line feeds stand alone.
_FOLD = textvec.fold_table((0x20,), lower=False)
_PARTS = np.ones(256, np.uint8)
_PARTS[0x20], _PARTS[0x0A] = 0, 4
_MARKED = textvec.constants(1, 31)[0]

_loaded: dict = {}


def model(path: str) -> "Pieces":
    """One model a worker process and file."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.text = [m.id_to_piece(i) for i in range(n)]
        self.unknown = m.unk_id()
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if m.is_byte(i)}
        odd = {i for i in range(n) if m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)}
        self.id = {self.text[i]: i for i in range(n) if i not in odd}
        self.score = [m.get_score(i) for i in range(n)]
        self.place = {p: k for k, p in enumerate(sorted({"", *(p[:n] for p in self.id for n in range(1, len(p) + 1))}))}  # automaton: "" is 0
        self.prefix = list(self.place)
        self.steps: dict[tuple[int, str], int] = {}
        self.ends: list = [None] * len(self.prefix)
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.id):
            raise ValueError("a piece of this model crosses the start of a marked word")
        probe = "a  b\tc éﬁ\n"
        if m.decode(m.encode(probe)) != probe or m.id_to_piece(m.encode("a")[0])[0] != MARK:
            raise ValueError("this model normalises texts or has no word prefix; only marked, unchanged texts are done here")
        raw = [t.replace(MARK, " ").encode() for t in self.text]
        for b, i in self.byte.items():
            raw[i] = bytes([b])
        for i in range(n):
            if m.is_control(i):
                raw[i] = b""
        raw[self.unknown] = " ⁇ ".encode()
        self.raw = raw
        self.table = Table()
        self.pairs = array("Q", [_NO_PAIR]) * PAIRS  # pair, then one bit for its answer
        self.whole: dict[int, bool] = {}

    # ------------------------------------------------------------ merging by score

    def merge(self, text: str, cut: int = 0) -> list[str] | None:
        """BPE: merge the pair with the best score, the leftmost of equals, while there is one. None as soon as a merge goes over ``cut``."""
        part = list(text)
        n = len(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list = []

        def push(i, j):
            if i >= 0 and j < n and (k := self.id.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (-self.score[k], i, j, len(part[i]) + len(part[j])))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not part[i] or not part[j] or len(part[i]) + len(part[j]) != size or after[i] != j:
                continue
            if j == cut:  # never 0
                return None
            part[i], part[j] = part[i] + part[j], ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        return [p for p in part if p]

    def _stays(self, k: int) -> bool:
        if (x := self.whole.get(k)) is None:
            x = self.whole[k] = self.merge(self.text[k]) == [self.text[k]]
        return x

    def _apart(self, a: int, b: int) -> bool:
        x = self.merge(self.text[a] + self.text[b], len(self.text[a])) == [self.text[a], self.text[b]] and self._stays(b)
        self.pairs[(a * 40503 ^ b) & (PAIRS - 1)] = (a << 32 | b) << 1 | x
        return x

    # ------------------------------------------------------------ forward pass over sorted words

    def _step(self, state: int, c: str) -> int:
        """The longest prefix of a piece that ends a text in ``state`` and then ``c``."""
        text = self.prefix[state] + c
        while (x := self.place.get(text)) is None:
            text = text[1:]
        if len(self.steps) >= STEPS:
            self.steps.clear()
        self.steps[state, c] = x
        return x

    def _ends(self, state: int) -> list[tuple[int, int]]:
        """(length, piece) of the pieces that a text in ``state`` ends with, the longest first."""
        text = self.prefix[state]
        x = self.ends[state] = [(len(text) - a, k) for a in range(len(text)) if (k := self.id.get(text[a:])) is not None]
        return x

    def _unknown_char(self, c: str) -> tuple:
        data = c.encode("utf-8", "replace")
        return tuple(self.byte[b] for b in data) if all(b in self.byte for b in data) else (self.unknown,)

    def forward(self, words: list[str]) -> dict[str, tuple]:
        """Piece ids of distinct words, by depth-first traversal of their trie."""
        ids, pairs, steps, ends = self.id, self.pairs, self.steps, self.ends
        out: dict[str, tuple] = {}
        last, start, score = [-1], [0], [0.0]  # states of the current path: piece (-1: none), its start, forward score
        at = [0]  # the automaton's
        path = ""
        for w in sorted(words):
            if MARK + MARK in w:
                out[w] = tuple(x for p in self.merge(w) for x in ((ids[p],) if p in ids else self._unknown_char(p)))
                continue
            same, most = 0, min(len(path), len(w))
            while same < most and path[same] == w[same]:
                same += 1
            del last[same + 1 :], start[same + 1 :], score[same + 1 :], at[same + 1 :]
            state = at[same]
            for d, c in enumerate(w[same:], same + 1):
                if (x := steps.get((state, c))) is None:
                    x = self._step(state, c)
                state = x
                at.append(state)
                found = ends[state]
                for size, k in self._ends(state) if found is None else found:
                    a = d - size
                    u = last[a]
                    if u < 0:
                        good = self._stays(k)
                    else:
                        kept = pairs[(u * 40503 ^ k) & (PAIRS - 1)]
                        good = kept & 1 if kept >> 1 == (u << 32 | k) else self._apart(u, k)
                    if good:
                        last.append(k)
                        start.append(a)
                        score.append(score[a] + self.score[k])
                        break
                else:  # no piece for this character: it stands alone, whatever is beside it
                    last.append(-1)
                    start.append(d - 1)
                    score.append(score[d - 1])
            path = w
            back, d = [], len(w)
            while d:
                back.append((last[d],) if last[d] >= 0 else self._unknown_char(w[d - 1]))
                d = start[d]
            out[w] = tuple(x for p in reversed(back) for x in p)
        return out

    # ------------------------------------------------------------ texts

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Piece ids of texts, each text by itself."""
        units = [_UNITS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self.forward(list({u for us in units for u in us}))
        return [[i for u in us for i in known[u]] for us in units]

    def _odd(self, column, w: textvec.Words) -> np.ndarray:
        """Texts with runs of spaces, spaces at an end or before a line feed, line feeds at the start, or the mark itself."""
        d, o = w.data, w.offsets
        odd = pc.match_substring(column, MARK).fill_null(False).to_numpy(zero_copy_only=False)
        full = np.flatnonzero(np.diff(o))
        odd[full] |= np.isin(d[o[full]], (0x20, 0x0A)) | (d[o[full + 1] - 1] == 0x20)
        at = np.flatnonzero((d[o[0] : o[-1] - 1] == 0x20) & ((d[o[0] + 1 : o[-1]] == 0x20) | (d[o[0] + 1 : o[-1]] == 0x0A))) + o[0]
        odd[np.searchsorted(o, at, "right") - 1] = True
        return odd

    def column(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds): the ids of text i are ids[bounds[i]:bounds[i + 1]]. Nulls are empty."""
        w = textvec.words(column, _FOLD, parts=_PARTS)
        if not len(w.hash):
            if not (np.diff(w.offsets) > 0).any():
                return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        first = np.zeros(len(w.hash), bool)
        first[w.bounds[:-1][np.diff(w.bounds) > 0]] = True
        marked = first | (w.data[np.maximum(w.start - 1, 0)] == 0x20)
        marked &= ~((w.data[w.start] == 0x0A) & (w.end - w.start == 1))
        checks = ends_check(w)
        keys = textvec.mix(w.hash + checks) ^ np.where(marked, _MARKED, np.uint64(0))
        if len(self.table.keys) > TABLE_WORDS or len(self.table.pool) > TABLE_IDS:
            self.table = Table()
        at = self.table.find(keys, checks)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            pick = miss[np.unique(keys[miss], return_index=True)[1]]
            data, base = w.data[w.offsets[0] : w.offsets[-1]].tobytes(), int(w.offsets[0])
            new = [("▁" if m else "") + data[a:b].decode() for m, a, b in zip(marked[pick].tolist(), (w.start[pick] - base).tolist(), (w.end[pick] - base).tolist())]
            known = self.forward(new)
            lists = [known[u] for u in new]
            self.table.add(keys[pick], checks[pick], np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists]))
            self.table.index()
            at[miss] = self.table.find(keys[miss], checks[miss])
            if (at < 0).any():
                raise ValueError("two words share their hash")
        ids = self.table.ids(at)
        bounds = np.concatenate(([0], np.cumsum(self.table.count[at])))[w.bounds]
        odd = np.flatnonzero(self._odd(column, w))
        if len(odd):
            own = dict(zip(odd.tolist(), self.encode([column[i].as_py() for i in odd.tolist()])))
            texts = [np.array(own[i], np.uint32) if i in own else ids[a:b] for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]
            ids, bounds = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        return ids, bounds

    def decode_bytes(self, ids: list[int]) -> bytes:
        data = b"".join(map(self.raw.__getitem__, ids))
        return data[1:] if data.startswith(b" ") else data

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, ids array<int>, round_trip (decoding the ids gives the text back) of every row.

    Null and empty texts have no pieces. A text with the mark character U+2581 itself decodes to a space there, as in the
    library, and so has round_trip false. Rows with null or repeated doc_id are encoded each; an empty table gives an
    empty one; other columns are not looked at."""

    def run(batches):
        m = model(path)
        for b in textvec.slices(batches, 1, SLICE):
            ids, bounds = m.column(b.column(1))
            flat = ids.tolist()
            data, offsets = textvec.text_bytes(b.column(1))
            same = [
                m.decode_bytes(flat[x:y]) == data[s:e].tobytes()
                for x, y, s, e in zip(bounds.tolist(), bounds[1:].tolist(), offsets.tolist(), offsets[1:].tolist())
            ]
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(bounds)), lists, pa.array(same)], ["doc_id", "n_pieces", "ids", "round_trip"])

    small_batches(docs.sparkSession)
    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pieces long, ids array<int>, round_trip boolean"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, out)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows with ``ids``; null ids give an empty text."""

    def run(batches):
        m = model(path)
        for b in batches:
            texts = [m.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    out = f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string"
    return encoded.select("doc_id", "ids").mapInArrow(run, out)
