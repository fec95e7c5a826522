"""The manifest, fingerprints and phrases against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from batchlens.llm import collocations, merkle, queries, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _table(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# ---------------------------------------------------------------- Merkle manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def _proof(levels, at):
    """(siblings before, siblings after) of every level."""
    out = []
    for level in levels[:-1]:
        lo = at - at % 3
        out.append((level[lo:at], level[at + 1 : lo + 3]))
        at //= 3
    return out


def brute_merkle(rows):
    """Rows as the query returns them, by full lists."""
    trees = {}
    for doc_id, text, lang, source, n in rows:
        leaf = _h(*map(_field, (doc_id, source, lang, n, text)))
        other = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
            other = text.replace("\n", "")
        trees.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, _h(*map(_field, (doc_id, source, lang, n, other)))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: _levels([x[2] for x in sorted(trees[s])]) for s in names}
    top = _levels([own[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (has, doc_id, leaf, claim) in enumerate(sorted(trees[s])):
            proof = _proof(own[s], at) + _proof(top, k)
            acc = claim
            for before, after in proof:
                acc = _h(*before, acc, *after)
            digest = _h(*[x for b, a in proof for x in (*b, *a)])
            out.append((doc_id if has else None, leaf, own[s][-1][0], top[-1][0], digest, acc, acc == top[-1][0]))
    return sorted(out, key=str)


def _odd_rows(n=60):
    r = random.Random(3)
    rows = [(k, "a\nb" * r.randrange(3), "en", r.choice(["x", "é", "Z", None]), k % 7) for k in range(n)]
    return rows + [(None, "nobody", None, "x", None), (5, None, "en", "x", 1), (5, "same id", "en", "x", 1), (7, "twice\n", "en", "one", 1), (7, "twice\n", "en", "one", 1), (8, "", "en", "alone", 0)]


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest_equals_full_lists(spark, depth):
    rows = _odd_rows()
    docs = spark.createDataFrame([(*r, "extra", 0) for r in rows], SCHEMA + ", pos string, total int")
    own = [F.col(c) for c in merkle.FIELDS]
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.manifest(docs, merkle.row_digest(own), merkle.row_digest([*own[:-1], text]), depth=depth)
    out = out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256), "folded_root", F.col("folded_root") == F.col("root"), "proof", "places"
    ).collect()
    assert sorted([tuple(r[:7]) for r in out], key=str) == brute_merkle(rows)
    for r in out:  # proofs are real: every leaf folds to the root
        assert merkle.fold(r["leaf"], r["proof"], r["places"]) == r["root"]


def test_manifest_of_more_leaves_than_a_superblock(spark, tmp_path):
    rows = [(k * 3, f"t{k}\n", "en", "hot" if k % 7 else "cold", k) for k in range(6000)]
    got = queries.op11_merkle(spark, _table(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_merkle(rows)


def test_manifest_of_nothing_and_of_one(spark, tmp_path):
    assert queries.op11_merkle(spark, _table(spark, tmp_path / "none", [])).count() == 0
    one = [(4, "a\nb", None, None, None)]
    got = queries.op11_merkle(spark, _table(spark, tmp_path / "one", one)).collect()
    assert list(map(tuple, got)) == brute_merkle(one)


# ---------------------------------------------------------------- SimHash


def _fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(rows):
    """Smallest doc_id reachable, by all pairs."""
    nodes = {}
    for doc_id, text in rows:
        if doc_id is not None:
            nodes.setdefault(doc_id, set()).add(_fingerprint(text))
    best = {d: d for d in nodes}
    moved = True
    while moved:
        moved = False
        for a in nodes:
            for b in nodes:
                if best[b] < best[a] and any((x ^ y).bit_count() <= 3 for x in nodes[a] for y in nodes[b]):
                    best[a], moved = best[b], True
    return best


def test_near_duplicates_equal_all_pairs(spark, tmp_path):
    r = random.Random(1)
    base = [" ".join(r.choice("abcdefghij") * 3 for _ in range(300)) for _ in range(12)]
    rows = []
    for k, text in enumerate(base):
        w = text.split()
        for j in range(6):
            w[r.randrange(len(w))] = f"x{j}"
            rows.append((k * 10 + j, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "One"), (204, "one"), (205, "two words ÄÖ"), (206, "Two words"), (None, base[0]), (300, base[1]), (300, base[2]), (301, base[3]), (301, base[3])]
    docs = spark.createDataFrame([(*x, "c", 1) for x in rows], "doc_id long, text string, fp string, label int")
    got = simhash.near_duplicates(docs).collect()
    want = _components(rows)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got if r["doc_id"] is not None) == sorted(
        (d, f"{_fingerprint(t):016x}", want[d]) for d, t in rows if d is not None
    )
    none = [r for r in got if r["doc_id"] is None]
    assert len(none) == 1 and none[0]["component_id"] is None and none[0]["fingerprint"] == f"{_fingerprint(base[0]):016x}"
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {None} | {d for d in want if want[d] == d}


def test_large_buckets_are_divided_without_loss(spark, monkeypatch):
    """Thousands of fingerprints around few centers, all in the same buckets, against all pairs."""
    r = np.random.default_rng(5)
    centers = r.integers(0, 2**63, 3, dtype=np.uint64)
    fps = {int(c) for c in centers}
    while len(fps) < 3000:
        x = int(centers[r.integers(3)])
        for b in r.integers(0, 64, r.integers(1, 9)):
            x ^= 1 << int(b)
        fps.add(x)
    all_fps = np.array(sorted(fps), np.uint64)
    monkeypatch.setattr(simhash, "LEAF", 40)
    links = simhash.close_links(spark.createDataFrame([(int(x),) for x in all_fps.view(np.int64)], "fp long")).collect()
    signed = {int(s): k for k, s in enumerate(all_fps.view(np.int64))}
    up = list(range(len(all_fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for link in links:
        a, b = signed[link["a"]], signed[link["b"]]
        assert (int(all_fps[a]) ^ int(all_fps[b])).bit_count() <= 3
        up[root(a)] = root(b)
    for k in range(len(all_fps)):
        for j in np.flatnonzero(np.bitwise_count(all_fps ^ all_fps[k]) <= 3).tolist():
            assert root(k) == root(j)


def test_blocks_cover_all_bits():
    mask = 0
    while mask.bit_count() < 64 - simhash.LAST:
        blocks = simhash.blocks_of(mask)
        added = [b ^ mask for b in blocks]
        assert len(added) == 4 and sum(added) == (1 << 64) - 1 - mask and all(x & mask == 0 for x in added)
        mask = blocks[0]


def test_fingerprint_of_a_long_text_in_pieces(monkeypatch):
    r = random.Random(2)
    text = "\n".join(" ".join(str(r.randrange(99)) * 2 for _ in range(9)) for _ in range(300))
    for size in (1, 7, 1000):
        monkeypatch.setattr(simhash, "CHUNK", size)
        assert simhash.fingerprint(text.encode()) == _fingerprint(text)


# ---------------------------------------------------------------- phrases


def brute_counts(rows, max_words=3):
    """Counter of (lang, phrase) and words of each language."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, " ".join(w[i : i + k])) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    return f, n


def brute_collocations(rows, top, min_count=10, max_words=3, percent=50):
    f, n = brute_counts(rows, max_words)
    cand = {x: a for x, a in f.items() if " " in x[1] and a >= min_count}
    out = []
    for (lang, phrase), a in cand.items():
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            l, r = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        inside = any(y == lang and len(q.split()) > len(w) and f" {phrase} " in f" {q} " and 100 * b >= percent * a for (y, q), b in cand.items())
        if not inside:
            score, _, l, r = min(cuts)
            out.append((lang, phrase, a, l, r, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], k, *x[1:]) for k, x in enumerate(own[:top], 1)]
    return sorted(ranked)


def _texts(n=250, words=14, seed=4):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "ñandú", "NUL\0x", "(A)"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!? ", " \x0b"]
    return [("".join(r.choice(vocabulary) + r.choice(ends) for _ in range(r.randrange(40)))) for _ in range(n)]


@pytest.mark.parametrize("share,lowered", [(250, 2), (1, 50), (1000, 1)])
def test_collocations_equal_brute_force(spark, monkeypatch, share, lowered):
    """Whatever the sample proposes: a usual one, nothing at all (all are border failures), everything."""
    monkeypatch.setattr(collocations, "SHARE", share)
    monkeypatch.setattr(collocations, "LOWERED", lowered)
    r = random.Random(6)
    rows = [(r.choice(["en", "fr", None]), t) for t in _texts()] + [("en", None), ("fr", ""), ("xx", "rare words")]
    rows += [("en", "same row, new york times")] * 12
    docs = spark.createDataFrame([(k % 90 or None, t, lang, "s", 0) for k, (lang, t) in enumerate(rows)], SCHEMA.replace("n_chars", "phrase"))
    got = collocations.collocations(docs, top=40).collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows, 40)
    assert collocations.collocations(docs.limit(0)).count() == 0


@pytest.mark.parametrize("max_words", [3, 4])
def test_one_pass_closes_all_border_failures(spark, monkeypatch, max_words):
    """The sample proposes no word of a frequent phrase: the expansion pass counts its pairs and what is longer around them at once."""
    monkeypatch.setattr(collocations, "SHARE", 1)
    monkeypatch.setattr(collocations, "LOWERED", 50)
    passes, real = [], collocations._pass
    monkeypatch.setattr(collocations, "_pass", lambda *a: passes.append(a) or real(*a))
    rows = [("en", t) for t in _texts(150, 4, 12)] + [("fr", "one two three four five")] * 11
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    got = {(r.lang, r.phrase): r.c for r in collocations.phrase_counts(docs, 10, max_words).where("k > 0").collect()}
    assert got == {k: c for k, c in brute_counts(rows, max_words)[0].items() if c >= 10}
    assert len(passes) == 3  # the sample's, the full and the expansion pass


def test_longer_phrases_than_three_words(spark):
    rows = [("en", t) for t in _texts(200, 3, 8)]
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    got = collocations.collocations(docs, top=500, min_count=15, max_words=5, percent=40).collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows, 500, 15, 5, 40)


@pytest.mark.parametrize("size", [16, 64, 1000])
def test_counts_of_texts_in_slices(monkeypatch, size):
    """Texts longer than a slice, with and without ends of pieces, count as whole ones."""
    monkeypatch.setattr(collocations, "SLICE", size)
    rows = [("en", t) for t in _texts(20, 5, 9)] + [("en", " ".join(_texts(5, 4, 10)).replace("\n", " ").replace(".", " ").replace(",", " ").replace("!?", " ").replace("\x0b", "\t"))]
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows]), pa.array([x for x, _ in rows])], ["text", "lang"])
    got = Counter()
    for b in collocations._count(None, None, 3)([batch]):
        for r in b.to_pylist():
            if r["k"]:
                got[r["lang"], r["phrase"]] += r["c"]
    assert got == brute_counts(rows)[0]


def test_phrases_that_a_filter_holds_by_chance():
    """The old pass did not come to "a b" (it has no "a"), though its filter holds "a b" by chance: the next pass counts "a b c"."""

    def keys(*phrases):
        batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(phrases)), pa.array([len(p.split()) for p in phrases]), pa.array(phrases)], ["lang", "k", "phrase"])
        return next(collocations._phrase_keys([batch])).column("key").to_numpy().view(np.uint64)

    class Sent:
        def __init__(self, *filters):
            self.value = []
            for phrases in filters:
                bits = np.zeros(collocations.BLOOM_BITS // 8, np.uint8)
                for h in keys(*phrases).tolist():
                    for p in (h % collocations.BLOOM_BITS, (h >> 32) % collocations.BLOOM_BITS):
                        bits[p >> 3] |= 1 << (p & 7)
                self.value.append(bits.tobytes())

    batch = pa.RecordBatch.from_arrays([pa.array(["a b c. b c d"]), pa.array(["en"])], ["text", "lang"])
    first = Sent(["b", "c", "d"], ["a b", "b c", "c d"])
    second = Sent(["a", "b", "c", "d"], ["a b", "b c", "c d"])
    got = Counter()
    for old, new in ((None, first), (first, second)):
        for b in collocations._count(old, new, 3)([batch]):
            got.update({r["phrase"]: r["c"] for r in b.to_pylist() if r["k"]})
    assert got == Counter({"a": 1, "b": 2, "c": 2, "d": 1, "a b": 1, "b c": 2, "c d": 1, "a b c": 1, "b c d": 1})


def test_scores_past_64_bits(spark):
    big = 9_000_000_000
    counts = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big - 1)], "lang string, k int, phrase string, c long")
    row = collocations.scored(counts).first()
    assert row["score"] == 1000000 * (big - 1) ** 2 // big**2
