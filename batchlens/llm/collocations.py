"""Phrases that occur more often than chance would have it, mined by Toivonen's method.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words. A phrase is 1 to ``max_words``
consecutive words of a piece; all is counted for each language on its own.

1. A sample of the documents (SHARE of them, by hash) proposes phrases: those that occur there at least LOWERED times.
2. A full pass counts all words, and every longer phrase whose two parts of one word less are both proposed. These are the proposed phrases and
   their negative border: what could be frequent for all the sample tells, but was not seen often enough there. Counts are exact.
3. If a phrase that was not proposed turns out frequent (a border failure), longer phrases around it have not been looked at. It joins the
   proposals, and one expansion pass counts the phrases that are new to them, and the longer ones around these, frequent or not.

As a phrase cannot be more frequent than its parts, no frequent phrase is missed after the two passes, whatever the sample was: both its parts are
frequent, so each was counted in the full pass and is proposed by now, or is new in the expansion pass. Proposals are passed on as Bloom filters of a fixed size: a false positive (or a full filter) only makes a pass count more, and since a pass skips exactly what
the pass before came to through its filters, from the words on, every phrase is counted once and whole.

Tasks work on slices of about SLICE bytes of text (long texts are cut between pieces, or between words with the last words carried over), count in
numpy and send a row for each distinct phrase of a slice, so a common phrase is a row a slice; Spark adds them up by phrase, and only frequent phrases
are stored.

Defined results: null and empty texts have no words; a null lang is ``und``; equal rows count each; tables without a phrase give an empty result; columns
other than the text, the language and ``doc_id`` (only hashed, for the sample) are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm import textvec
from batchlens.llm.shared import BLOOM_BITS, bloom, bloom_mask, stored

#: Share of the documents (in 1/1000) that the sample has, and the least count there of a proposed phrase.
SHARE = 250
LOWERED = 2
SLICE = 2 << 20
#: Parts of a language whose best phrases are found apart before the last ranking.
PARTS = 64
UNKNOWN = "und"

_PIECE_ENDS = (0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D)
_BLANKS = (0x20, 0x09)
_WORD_BYTES = textvec.fold_table((*_PIECE_ENDS, *_BLANKS))
_ENDS = np.zeros(256, bool)
_ENDS[list(_PIECE_ENDS)] = True
_GAPS = _ENDS.copy()
_GAPS[list(_BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ROWS = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("c", pa.int64())])


# ---------------------------------------------------------------- words and pieces


def _cuts(data: np.ndarray, max_words: int):
    """A long text in parts (bytes, words carried over from the part before)."""
    at, kept = 0, b""
    while at < len(data):
        end = min(at + SLICE, len(data))
        carry = 0
        if end < len(data):
            last = np.flatnonzero(_ENDS[data[at:end]])
            if len(last):
                end = at + int(last[-1]) + 1
            else:
                while end < len(data) and not _GAPS[data[end]]:
                    end += 1
                carry = max_words - 1
        part = kept + data[at:end].tobytes()
        yield part, len(kept.split())
        words = part.replace(b"\t", b" ").split(b" ") if carry else []
        words = [w for w in words if w][-carry:] if carry else []
        kept = b" ".join(words) + b" " if words else b""
        at = end


def _texts(batches, max_words: int):
    """(lang, texts, carried words of the first text) in slices of bounded size."""
    for b in textvec.slices(batches, 0, SLICE):
        langs = b.column(1).dictionary_encode()
        codes = np.asarray(langs.indices)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = b.column(0).filter(pa.array(codes == code))
            data, offsets = textvec.text_bytes(texts)
            if offsets[-1] - offsets[0] <= SLICE:
                yield lang, texts, 0
                continue
            for i in range(len(texts)):
                for part, carried in _cuts(data[offsets[i] : offsets[i + 1]], max_words):
                    yield lang, pa.array([part.decode("utf-8")]), carried


class _Slice:
    """Words of a slice: codes (places in the distinct words), their hashes, which word follows which in one piece."""

    def __init__(self, texts):
        w = textvec.words(texts, _WORD_BYTES)
        self.n = n = len(w.hash)
        if not n:
            return
        size = w.end - w.start
        offsets = np.concatenate(([0], np.cumsum(size)))
        place = np.arange(offsets[-1]) + np.repeat(w.start - offsets[:-1], size)
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[w.data[place]])]
        words = pa.Array.from_buffers(pa.large_string(), n, buffers).dictionary_encode()
        self.codes = words.indices.to_numpy().astype(np.int64)
        self.words = words.dictionary
        self.hash = np.empty(len(self.words), np.uint64)
        self.hash[self.codes] = w.hash
        ends = np.concatenate(([0], np.cumsum(_ENDS[w.data[w.start[0] : w.end[-1]]])))
        follows = ends[w.end[:-1] - w.start[0]] == ends[w.start[1:] - w.start[0]]
        first = w.bounds[1:-1]  # the first word of a text follows no other
        follows[first[(first > 0) & (first < n)] - 1] = False
        self.follows = follows


def _key(h: np.ndarray, lang: str, words: int) -> np.ndarray:
    """Filter key of phrases from the hash of their words."""
    return textvec.mix(h + textvec.words(pa.array([f"{words} {lang}"]), textvec.fold_table((0,), lower=False)).hash[0])


def _step(h: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Hash of phrases with one more word."""
    return textvec.mix(h * np.uint64(0x9E3779B97F4A7C15)) + nxt


def _count(old, new, max_words: int):
    """Text, lang to (lang, k, phrase, c): k = 1 the words and k = 0 the number of all words (first pass, ``old`` None), and the k-word phrases that the
    filters ``new`` (None: all) let through and ``old`` did not: both parts of k - 1 words are in the filter, and so on down to the words. A filter a
    phrase length, from 1. A part that is in the old filter by chance, while a word of it is not, was never reached, nor was any phrase around it.
    With ``old``, a part that is counted in this pass itself goes for one that is let through."""

    def run(batches):
        allowed = None if new is None else [np.frombuffer(x, np.uint8) for x in new.value]
        before = None if old is None else [np.frombuffer(x, np.uint8) for x in old.value]
        for lang, texts, carried in _texts(batches, max_words):
            s = _Slice(texts)
            if not s.n:
                continue
            if before is None:
                counts = np.bincount(s.codes[carried:], minlength=len(s.words))
                yield _rows(lang, 1, s.words, counts)
                yield _rows(lang, 0, pa.array([""]), np.array([s.n - carried]))
            at, codes, hashes, phrases = np.arange(s.n), s.codes, s.hash, s.words
            counted = np.full(s.n, before is not None)  # of the phrases at ``at``: whether the old pass came to them
            for k in range(2, max_words + 1):
                # the phrases of k - 1 words that begin at ``at``: codes into (hashes, phrases)
                mine = np.full(s.n, -1)
                mine[at] = codes
                reached = np.zeros(s.n, bool)
                reached[at] = counted
                begin = at[at + k - 1 < s.n]
                begin = begin[s.follows[begin + k - 2]]
                begin = begin[mine[begin + 1] >= 0]
                left, right = mine[begin], mine[begin + 1]
                wanted = np.ones(len(begin), bool)
                counted = np.zeros(len(begin), bool)
                if allowed is not None:
                    ok = bloom_mask(allowed[k - 2], _key(hashes, lang, k - 1))
                    wanted = ok[left] & ok[right]
                if before is not None:
                    was = bloom_mask(before[k - 2], _key(hashes, lang, k - 1))
                    counted = was[left] & was[right] & reached[begin] & reached[begin + 1]
                    wanted = (ok[left] | ~reached[begin]) & (ok[right] | ~reached[begin + 1])
                begin, left, counted = begin[wanted], left[wanted], counted[wanted]
                if not len(begin):
                    break
                last = s.codes[begin + k - 1]
                pairs = pa.array(left * len(s.words) + last).dictionary_encode()
                distinct = pairs.dictionary.to_numpy()
                head, tail = distinct // len(s.words), distinct % len(s.words)
                phrases = _joined(phrases, head, s.words, tail)
                hashes = _step(hashes[head], s.hash[tail])
                codes, at = pairs.indices.to_numpy().astype(np.int64), begin
                fresh = ~counted & (at + k - 1 >= carried)
                yield _rows(lang, k, phrases, np.bincount(codes[fresh], minlength=len(phrases)))

    return run


def _joined(a, i, b, j):
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(a.take(pa.array(i)), b.take(pa.array(j)), pa.scalar(" ", pa.large_string()))


def _rows(lang, k, phrases, counts):
    some = np.flatnonzero(counts)
    n = len(some)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, k, np.int32)), phrases.take(pa.array(some)).cast(pa.string()), pa.array(counts[some])],
        schema=_ROWS,
    )


def _pass(texts: DataFrame, old, new, max_words: int) -> DataFrame:
    rows = texts.mapInArrow(_count(old, new, max_words), "lang string, k int, phrase string, c long")
    # A slice's rows are added up already, and most phrases are rare: adding them up once more before the exchange would cost more than it saves.
    rows = rows.repartition("phrase")
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("c").alias("c"))


# ---------------------------------------------------------------- proposals


def _phrase_keys(batches):
    """lang, k, phrase to k, the phrase's filter key."""
    for b in batches:
        lang, size = b.column("lang").to_pylist(), b.column("k").to_numpy()
        w = textvec.words(b.column("phrase"), textvec.fold_table(_BLANKS, lower=False))
        out = np.zeros(b.num_rows, np.uint64)
        for k in np.unique(size).tolist():
            rows = np.flatnonzero(size == k)
            h = w.hash[w.bounds[rows]]
            for j in range(1, k):
                h = _step(h, w.hash[w.bounds[rows] + j])
            for x in sorted({lang[r] for r in rows.tolist()}):
                mine = np.array([lang[r] == x for r in rows.tolist()])
                out[rows[mine]] = _key(h[mine], x, k)
        yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(out.view(np.int64))], ["k", "key"])


def _filters(phrases: DataFrame, max_words: int) -> list[bytes]:
    keys = stored(phrases.select("lang", "k", "phrase").mapInArrow(_phrase_keys, "k int, key long"), "phrase-keys")
    return [bloom(keys.where(F.col("k") == k), F.col("key")) for k in range(1, max_words)]


def _outside(filters):
    """The phrases that the filters do not let through."""

    def run(batches):
        bits = [np.frombuffer(x, np.uint8) for x in filters.value]
        for b in batches:
            size = b.column("k").to_numpy()
            key = next(_phrase_keys([b])).column("key").to_numpy().view(np.uint64)
            out = np.zeros(b.num_rows, bool)
            for k, x in enumerate(bits, 1):
                mine = size == k
                out[mine] = ~bloom_mask(x, key[mine])
            yield b.filter(pa.array(out))

    return run


def phrase_counts(docs: DataFrame, min_count: int = 10, max_words: int = 3, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, k, phrase, c): every phrase of 1 to ``max_words`` words that occurs at least ``min_count`` times, and a row with k = 0 and
    the number of all words of each language. Exact."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col(text).cast("string")), F.lit(1000)).alias("draw"),
    )
    texts = rows.where("text is not null").select("text", "lang")
    sample = rows.where((F.col("draw") < SHARE) & F.col("text").isNotNull()).select("text", "lang")
    proposed = _pass(sample, None, None, max_words - 1).where((F.col("k") > 0) & (F.col("c") >= LOWERED))
    bits = _filters(proposed, max_words)
    new = sc.broadcast(bits)
    found = stored(_pass(texts, None, new, max_words).where((F.col("k") == 0) | (F.col("c") >= min_count)), "phrases")
    missed = found.where(f"k between 1 and {max_words - 1}").mapInArrow(_outside(new), "lang string, k int, phrase string, c long")
    missed = stored(missed, "border-failures")
    if missed.isEmpty():
        return found
    bits = [(np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes() for a, b in zip(bits, _filters(missed, max_words))]
    return found.unionByName(stored(_pass(texts, new, sc.broadcast(bits), max_words).where(F.col("c") >= min_count), "phrases"))


# ---------------------------------------------------------------- scores


def _words(c, start, stop):
    return F.array_join(F.slice(c, start, stop), " ")


def scored(counts: DataFrame, max_words: int = 3) -> DataFrame:
    """(lang, phrase, k, a, l, r, score): every phrase of 2 words or more at its lowest-scoring cut (ties to the first)."""
    parts = counts.where("k > 0").select("lang", "phrase", "c")
    long = counts.where("k > 1").select("lang", "phrase", "k", F.col("c").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "k", "a", "cut", _words("w", F.lit(1), F.col("cut")).alias("head"), _words("w", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail")
    )
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("c").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("tail"), F.col("c").alias("r")), ["lang", "tail"])
    # decimals: 10^6 a a and l r pass 64 bits; a quotient of at most 10^6 does not
    cuts = cuts.selectExpr(
        "lang", "phrase", "k", "a", "cut", "l", "r",
        "cast((cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0)))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long) as score",
    )
    best = cuts.groupBy("lang", "phrase", "k", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("at"))
    return best.select("lang", "phrase", "k", "a", "at.l", "at.r", "at.score")


def drop_contained(candidates: DataFrame, percent: int = 50) -> DataFrame:
    """Candidates without those that lie in a longer candidate at least ``percent`` percent as frequent."""
    w = F.split("phrase", " ")
    lengths = candidates.where("k > 2").select("lang", w.alias("w"), "k", F.col("a").alias("longer"), F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("n"))
    inner = lengths.select("lang", "w", "longer", "n", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("n") + 1)).alias("at"))
    inner = inner.select("lang", _words("w", F.col("at"), F.col("n")).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(inner, ["lang", "phrase"], "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 10, max_words: int = 3, percent: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by score, frequency and phrase."""
    counts = phrase_counts(docs, min_count, max_words)
    kept = stored(drop_contained(scored(counts, max_words), percent), "collocations")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    near = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("place") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = counts.where("k = 0").select("lang", F.col("c").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
with recursive t as (
  select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) p from t),
w as (select lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') w from pieces),
grams as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') phrase
  from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) i from w, (values (1), (2), (3)) ks(k) where len(w) >= k) g),
f as (select lang, k, phrase, count(*) c from grams group by all),
n as (select lang, sum(c)::bigint n from f where k = 1 group by lang),
cand as (select lang, k, phrase, c a, string_split(phrase, ' ') w from f where k > 1 and c >= 10),
cuts as (
  select lang, k, phrase, a, cut, array_to_string(w[1 : cut], ' ') h, array_to_string(w[cut + 1 : k], ' ') t
  from (select *, unnest(generate_series(1, k - 1)) cut from cand) c),
scores as (
  select c.lang, c.k, c.phrase, a, cut, fh.c l, ft.c r, ((1000000::hugeint * a * a) // (fh.c::hugeint * ft.c))::bigint score
  from cuts c join f fh on fh.lang = c.lang and fh.phrase = c.h join f ft on ft.lang = c.lang and ft.phrase = c.t),
best as (select * from scores qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner3 as (
  select lang, phrase, max(a) longer from (
    select lang, array_to_string(w[1 : 2], ' ') phrase, a from cand where k = 3
    union all select lang, array_to_string(w[2 : 3], ' '), a from cand where k = 3) x group by all),
kept as (select b.* from best b left join inner3 i using (lang, phrase) where longer is null or 100 * longer < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from kept)
select lang, rank::int rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000
"""
