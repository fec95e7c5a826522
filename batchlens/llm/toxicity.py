"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: keys are whole words and word beginnings of 3 to 7 bytes (lower case, look-alike digits and signs read as
letters), and a key's weight is its log odds in toxic against clean training texts, less one standard error. Features of a
text are lexicon densities in three tiers, the strongest and mean weights, second-person words and how many lexicon
words stand near one, capitals, punctuation, and obfuscated words. Scores take nothing but the text.

Training rows are a bounded sample (TRAIN_ROWS, by a hash of doc_id) of the labelled rows given, one of each group that shares its minwise
shingle, so that copies count once. They fall into three parts by another hash: the lexicon is learned on the first half,
the trees (Spark ML) on a quarter, the isotonic curve (Spark ML) on a quarter, so that no step sees texts the step before it has
learned by heart. Only the fitted model (lexicon of at most LEXICON keys, trees, curve) goes through the driver; texts are scored where
they are.

Defined results: null and empty texts are scored with all features 0; repeated rows are scored each; labels of one doc_id count as toxic if
any does; null labels are left out; without labelled rows of both classes every score is the share of toxic rows (0 if there are none);
an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm import textvec
from batchlens.llm.shared import bloom, bloom_mask, small_batches, stored

TRAIN_ROWS = 24_000
LEXICON = 50_000
PREFIXES = (3, 4, 5, 6, 7)
TIERS = (1.0, 3.0, 5.0)
NEAR = 5
TREES, DEPTH, RATE = 20, 4, 0.3
#: Bytes of text (one text at least) that a task works on at once.
SLICE = 2 << 20

#: White space and ASCII punctuation without the signs that stand for letters.
_LOOKALIKE = {ord(a): ord(b) for a, b in zip("0134579@$", "oieastgas")}
_BREAKS = (*textvec.SPACE, *(c for c in (*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)) if c not in _LOOKALIKE))
_TABLE = textvec.fold_table(_BREAKS, maps=_LOOKALIKE)
_KEY = textvec.constants(len(PREFIXES) + 1, 21)

#: Second-person words (English, German, French, Spanish).
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deiner euch euer tu toi te ton tes vous votre vos ti tuyo usted ustedes vosotros os"
).split()

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_SIGN[[ord("'"), ord("-")]] = False

NAMES = [
    "log_words", *[f"tier{t}_{x}" for t in range(len(TIERS)) for x in ("log", "density")], "strongest", "mean_weight", "second_person",
    "near_second_person", "capitals", "capital_words", "exclamations", "questions", "punctuation", "digits", "obfuscated",
]


def _keys(w: textvec.Words):
    """(key, valid) arrays for whole words and each beginning."""
    yield w.hash ^ _KEY[0], None
    for k, p in enumerate(w.prefixes):
        yield p ^ _KEY[k + 1], p != 0


def _words(column) -> textvec.Words:
    return textvec.words(column, _TABLE, PREFIXES)


# ---------------------------------------------------------------- lexicon


def _document_counts(filter_bits=None):
    """text to (key, documents that have it), a batch at a time; with a filter, of keys that pass it."""

    def run(batches):
        for b in textvec.slices(batches, 0, SLICE):
            w = _words(b.column(0))
            doc = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds)).astype(np.uint64)
            for keys, valid in _keys(w):
                keep = np.ones(len(keys), bool) if valid is None else valid
                if filter_bits is not None:
                    keep = keep & bloom_mask(np.frombuffer(filter_bits.value, np.uint8), keys)
                if not keep.any():
                    continue
                k, d = keys[keep], doc[keep]
                order = np.lexsort((d, k))
                k, d = k[order], d[order]
                new = np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])))
                found, n = np.unique(k[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    return run


def learn_lexicon(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted uint64 keys, weights) out of training rows (text, toxic)."""
    spark = rows.sparkSession
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic = rows.where("toxic = 1").select("text").mapInArrow(_document_counts(), "key long, n long")
    toxic = stored(toxic.groupBy("key").agg(F.sum("n").alias("pos")).where("pos >= 2"), "lexicon")
    bits = spark.sparkContext.broadcast(bloom(toxic, F.col("key")))
    clean = rows.where("toxic = 0").select("text").mapInArrow(_document_counts(bits), "key long, n long").groupBy("key").agg(F.sum("n").alias("neg"))
    pos, neg = F.col("pos") + 0.5, F.coalesce("neg", F.lit(0)) + 0.5
    weight = F.log(pos / (n.get(1, 0) + 1)) - F.log(neg / (n.get(0, 0) + 1)) - F.sqrt(1 / pos + 1 / neg)
    best = toxic.join(clean, "key", "left").select("key", weight.alias("w")).where(F.col("w") >= TIERS[0]).orderBy(F.desc("w"), "key").limit(LEXICON).collect()
    keys = np.array([r["key"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r["w"] for r in best], np.float64)[order]


# ---------------------------------------------------------------- features


class Lexicon(NamedTuple):
    keys: np.ndarray
    weights: np.ndarray
    table: np.ndarray  # which low 20 bits occur
    second: np.ndarray  # hashes of second-person words


def make_lexicon(keys: np.ndarray, weights: np.ndarray) -> Lexicon:
    table = np.zeros(1 << 20, bool)
    table[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return Lexicon(keys, weights, table, np.sort(_words(pa.array(SECOND_PERSON)).hash))


def features(column, lex: Lexicon) -> np.ndarray:
    """A row of NAMES for every text."""
    w = _words(column)
    docs = len(w.bounds) - 1
    n = np.diff(w.bounds)
    some = np.maximum(n, 1)
    weight = np.zeros(len(w.hash))
    if len(lex.keys):
        for keys, _ in _keys(w):
            at = np.flatnonzero(lex.table[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(lex.keys, keys[at]), len(lex.keys) - 1)
            exact = lex.keys[place] == keys[at]
            at, place = at[exact], place[exact]
            weight[at] = np.maximum(weight[at], lex.weights[place])
    hits = np.flatnonzero(weight)
    hit_doc = np.searchsorted(w.bounds, hits, "right") - 1
    cols = [np.log1p(n)]
    for tier in TIERS:
        k = np.bincount(hit_doc[weight[hits] >= tier], minlength=docs)
        cols += [np.log1p(k), k / some]
    strongest = np.zeros(docs)
    np.maximum.at(strongest, hit_doc, weight[hits])
    cols += [strongest, np.bincount(hit_doc, weights=weight[hits], minlength=docs) / some]
    you = np.flatnonzero(lex.second[np.minimum(np.searchsorted(lex.second, w.hash), len(lex.second) - 1)] == w.hash)
    strong = hits[weight[hits] >= TIERS[1]]
    strong_doc = np.searchsorted(w.bounds, strong, "right") - 1
    lo = np.searchsorted(you, np.maximum(strong - NEAR, w.bounds[strong_doc]))
    hi = np.searchsorted(you, np.minimum(strong + NEAR + 1, w.bounds[strong_doc + 1]))
    you_doc = np.searchsorted(w.bounds, you, "right") - 1
    cols += [np.bincount(you_doc, minlength=docs) / some, np.bincount(strong_doc[hi > lo], minlength=docs) / some]
    # bytes: a histogram a text
    size = np.diff(w.offsets)
    hist = np.zeros((docs, 256), np.int64)
    for i in np.flatnonzero(size):
        hist[i] = np.bincount(w.data[w.offsets[i] : w.offsets[i + 1]], minlength=256)
    upper, lower = hist[:, 65:91].sum(1), hist[:, 97:123].sum(1)
    size = np.maximum(size, 1)
    cap = np.zeros(len(w.hash), bool)
    odd = np.zeros(len(w.hash), bool)
    for a in range(0, len(w.hash), 1 << 18):  # words a slice at a time: their bytes' running sums
        s, e = w.start[a : a + (1 << 18)], w.end[a : a + (1 << 18)]
        part = w.data[s[0] : e[-1]]
        sums = np.zeros(len(part) + 1, np.int32)
        np.cumsum(_SIGN[part], out=sums[1:])
        inner = sums[e - s[0]] - sums[s - s[0]] > 0
        odd[a : a + (1 << 18)] = inner & _LETTER[w.data[s]] & _LETTER[w.data[e - 1]]
        first, last = w.data[s], w.data[e - 1]
        cap[a : a + (1 << 18)] = (e - s > 1) & (first >= 65) & (first <= 90) & (last >= 65) & (last <= 90)
    doc = np.repeat(np.arange(docs), n)
    cols += [
        upper / np.maximum(upper + lower, 1), np.bincount(doc[cap], minlength=docs) / some,
        hist[:, 33] / size, hist[:, 63] / size, hist[:, _SIGN].sum(1) / size, hist[:, 48:58].sum(1) / size,
        np.bincount(doc[odd], minlength=docs) / some,
    ]
    return np.column_stack(cols) if docs else np.zeros((0, len(NAMES)))


def with_features(rows: DataFrame, lexicon) -> DataFrame:
    """``rows`` (columns, the last of them text) with features array<double> in place of text."""
    keep = rows.columns[:-1]

    def run(batches):
        lex = make_lexicon(*lexicon.value)
        for part in textvec.slices(batches, len(keep), SLICE):
            x = features(part.column(len(keep)), lex)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*keep, "features"])

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{schema}, features array<double>")


# ---------------------------------------------------------------- model


def _minwise(batches):
    """A text's smallest 5-word shingle, by which copies are put together."""
    for b in textvec.slices(batches, 2, SLICE):
        w = textvec.words(b.column(2))
        mh = [int(s[0]) if len(s := textvec.shingles(w.hash[x:y], 5)) else 0 for x, y in zip(w.bounds[:-1], w.bounds[1:])]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.array(mh, np.uint64).view(np.int64))], ["doc_id", "toxic", "text", "group"])


class Model(NamedTuple):
    lexicon: tuple | None
    trees: object
    curve: object
    share: float


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, text, part): the bounded sample of labelled rows, copies once. part: 0, 1 lexicon, 2 trees, 3 curve."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    n = known.count()
    space = 1 << 30
    chosen = known.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(space)) < (space if n <= most else space * most // n))
    # at most about TRAIN_ROWS rows of 12 bytes
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    told = texts.select("doc_id", "toxic", "text").mapInArrow(_minwise, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic int, text string, `group` long")
    first = told.groupBy("group").agg(F.min_by(F.struct("doc_id", "toxic", "text"), F.struct("doc_id", "text")).alias("r")).select("r.*")
    return stored(first.withColumn("part", F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(4))), "toxic-train")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    spark = docs.sparkSession
    small_batches(spark)
    rows = training_rows(docs, labels, most)
    n = {(r["part"], r["toxic"]): r["count"] for r in rows.groupBy("part", "toxic").count().collect()}
    toxic, total = sum(k for (_, t), k in n.items() if t), sum(n.values())
    if not 0 < toxic < total:
        return Model(None, None, None, toxic / total if total else 0.0)
    full = all(n.get((p, t), 0) for p in range(4) for t in (0, 1))
    parts = {"lexicon": "part < 2", "trees": "part = 2", "curve": "part = 3"} if full else dict.fromkeys(("lexicon", "trees", "curve"), "true")
    lexicon = learn_lexicon(rows.where(parts["lexicon"]).select("text", "toxic"))
    sent = spark.sparkContext.broadcast(lexicon)
    data = stored(with_features(rows.select("toxic", "part", "text"), sent), "toxic-features").coalesce(4)
    data = data.select("part", F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("features")).cache()
    try:
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, minInstancesPerNode=5 if total > 1000 else 1, seed=1).fit(data.where(parts["trees"]))
        raw = trees.transform(data.where(parts["curve"])).select("label", vector_to_array("probability")[1].alias("raw"))
        curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    finally:
        data.unpersist()
    return Model(lexicon, trees, curve, toxic / total)


def score(docs: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The key columns and score (0 to 1) of every row."""
    if model.trees is None:
        return docs.select(*keys, F.lit(float(model.share)).alias("score"))
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model.lexicon)
    x = with_features(docs.select(*keys, F.col("text").cast("string").alias("text")), sent)
    raw = model.trees.transform(x.select(*keys, array_to_vector("features").alias("features"))).select(*keys, vector_to_array("probability")[1].alias("raw"))
    flat = model.curve.transform(raw)
    # the curve is flat in places; a thousandth of the trees' own score keeps their order there
    mixed = F.col("prediction") * 0.999 + F.col("raw") * 0.001
    return flat.select(*keys, F.greatest(F.lit(0.0), F.least(F.lit(1.0), mixed)).alias("score"))


def held_out(doc_id) -> object:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows that are not held out."""
    return fit(docs, labels.where(~held_out("doc_id")))


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows that score under ``limit``; all columns as they were. Of rows that share a doc_id, each is judged by its own text."""
    text = F.xxhash64(F.col("text").cast("string"))
    scored = score(docs.select("doc_id", text.alias("text_hash"), "text"), model, ("doc_id", "text_hash"))
    bad = scored.where(F.col("score") >= limit).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_text")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"].cast("string")) == bad["bad_text"]), "left_anti")
