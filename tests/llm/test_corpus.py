"""Near-duplicates, decontamination, line dedup, toxicity and the pipeline against brute force."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchlens.llm import decontam, linededup, neardup, textvec, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# ---------------------------------------------------------------- words


def test_words_in_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(textvec, "SLICE", 37)
    monkeypatch.setattr(textvec, "_powers", None)
    texts = ["Hello  World hello", None, "", "a b c d e " * 30, "x" * 200, "ñé HELLO \x00", " lead", "trail "]
    w = textvec.words(pa.array(texts), prefix_bytes=(3,))
    want = [x for t in texts for x in re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())]
    assert [w.data[a:b].tobytes() for a, b in zip(w.start, w.end)] == want
    by = defaultdict(set)
    for x, h in zip(want, w.hash):
        by[x.lower()].add(int(h))
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)


# ---------------------------------------------------------------- near duplicates


def brute_components(rows):
    sets, order = {}, []
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        sets.setdefault(i, []).append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    ids = [i for i in sets if i is not None]
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}, order


def near(rng, w, share):
    return [f"n{rng.randrange(10**6)}" if rng.random() < share else x for x in w]


def families(seed=0, groups=6, size=25):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(groups):
        base = words(rng, 150)
        for _ in range(size):
            rows.append((i := i + 1, " ".join(near(rng, base, rng.choice([0.0, 0.005, 0.02, 0.03, 0.05, 0.08])))))
    rows += [((i := i + 1), " ".join(words(rng, rng.randint(1, 60)))) for _ in range(60)]
    rng.shuffle(rows)
    return rows


def check_near(spark, rows):
    want, _ = brute_components(rows)
    got = neardup.near_duplicates(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all((r.component_id, r.kept) == ((want[r.doc_id], want[r.doc_id] == r.doc_id) if r.doc_id is not None else (None, True)) for r in got)
    return got


def test_near_duplicates_equal_brute_force(spark):
    check_near(spark, families())


@pytest.mark.parametrize("first_agree", [3, 11, 13])  # families of many, of few, of none
def test_near_duplicates_branch_and_blocks(spark, monkeypatch, first_agree):
    monkeypatch.setattr(neardup, "LEAF", 3)
    monkeypatch.setattr(neardup, "DEPTH", 1)
    monkeypatch.setattr(neardup, "FEW", 0)
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "COMPARED", 100)
    monkeypatch.setattr(neardup, "FIRST_AGREE", first_agree)
    monkeypatch.setattr(neardup, "PAIRS", 5)
    check_near(spark, families(3, 4, 30))


def test_near_duplicates_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "x y z u v"), (8, "x y z u v"), (8, "x y z u v"), (9, "q r s t u"), (9, "x y z u v"), (None, "a b")]
    got = check_near(spark, rows)
    assert {r.doc_id: r.n_shingles for r in got}[2] == 0
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0


def test_near_duplicates_clashing_names(spark):
    docs = docs_of(spark, families(2, 3, 5))
    more = docs
    for name in ("node", "cls", "comp", "n", "tokens", "sketch", "component_id", "kept", "gone_id"):
        more = more.withColumn(name, F.lit(name))
    want = neardup.near_duplicates(docs).orderBy("doc_id").collect()
    assert neardup.near_duplicates(more).orderBy("doc_id").collect() == want
    kept = neardup.drop_near_duplicates(more)
    assert kept.columns == more.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in want if r.kept}


def test_near_duplicates_threshold_is_inclusive(spark):
    a = [f"t{i}" for i in range(39)]  # 35 shingles; replacing the last word but four shares 30 of 40
    rows = [(1, " ".join(a)), (2, " ".join([*a[:34], "z", *a[35:]]))]
    check_near(spark, rows)


@pytest.mark.parametrize("dense", [0.5, 1.0])
def test_isolated_pairs_in_large_nodes(spark, monkeypatch, dense):
    """Pairs of exactly 0.75 (30 of 40 shingles) whose every shared node counts as large, without first links; with ``dense`` 1, every
    tree branches all the way."""
    monkeypatch.setattr(neardup, "LEAF", 1)
    monkeypatch.setattr(neardup, "DENSE", dense)
    monkeypatch.setattr(neardup, "FEW", 0)
    monkeypatch.setattr(neardup, "COMPARED", 0)
    monkeypatch.setattr(neardup, "FIRST_AGREE", 13)
    rng = random.Random(17)
    rows = []
    for i in range(0, 1200, 2):
        w = words(rng, 39, 10**9)
        rows += [(i, " ".join(w)), (i + 1, " ".join([*w[:34], "z", *w[35:]]))]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs_of(spark, rows)).collect()}
    assert [i for i in got if got[i] != i - i % 2] == []


def test_tiles_of_large_nodes(spark, monkeypatch):
    for name, value in (("LEAF", 3), ("FEW", 0), ("COMPARED", 100), ("WIDE", 4), ("FIRST_AGREE", 13)):
        monkeypatch.setattr(neardup, name, value)
    check_near(spark, families(3, 4, 30))


def test_groups_in_closed_nodes_link_in_rounds(spark, monkeypatch):
    """Groups of near copies without first links or families, one candidate a class and round: later rounds find the rest."""
    for name, value in (("LEAF", 2), ("FEW", 4), ("LIMIT", 1), ("FIRST_AGREE", 13), ("BLOCK", 8), ("AGREE", 20)):
        monkeypatch.setattr(neardup, name, value)
    rounds = []
    real = neardup._closed_pairs
    monkeypatch.setattr(neardup, "_closed_pairs", lambda paths, classes, most, again=None: rounds.append(most) or real(paths, classes, most, again))
    check_near(spark, families(3, 4, 30))
    assert rounds[:2] == [1, 8]


@pytest.mark.parametrize("known", [True, False])
def test_similar_groups_without_links_cost_a_few_pairs_a_class(spark, monkeypatch, known):
    """A group of similar texts, none linked, shares a passage with a larger one that has the center of the passage's nodes. With ``known`` False
    there are no first families, and only centers of the later rounds make some."""
    rng = random.Random(11)
    passage, one, two = words(rng, 40), words(rng, 60), words(rng, 60)
    texts = [" ".join([*passage, *one, *words(rng, 30)]) for _ in range(140)] + [" ".join([*passage, *two, *words(rng, 30)]) for _ in range(200)]
    rows = list(enumerate([*texts, texts[5] + " more"]))
    confirmed, stars = [], []
    compare, star = neardup._compare, neardup._star_pairs

    def counted(docs, classes, pairs, differences):
        confirmed.append(pairs.count())
        return compare(docs, classes, pairs, differences)

    def none_at_first(classes, shared):
        stars.append(1)
        return star(classes, shared).where(F.lit(known or len(stars) > 1))

    monkeypatch.setattr(neardup, "_compare", counted)
    monkeypatch.setattr(neardup, "_star_pairs", none_at_first)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == {d: 5 if d == 340 else d for d, _ in rows}
    assert sum(confirmed) < 15 * len(rows), confirmed  # all pairs of the two groups: 9730 and 19,900


def test_trees_share_no_function():
    places = {(t * neardup.DEPTH + d) * neardup.BRANCH + b for t in range(neardup.TREES) for d in range(neardup.DEPTH) for b in range(neardup.BRANCH)}
    assert len(places) == neardup.TREES * neardup.DEPTH * neardup.BRANCH and max(places) < neardup.SKETCH


def test_held_block_equals_all_pairs(monkeypatch):
    monkeypatch.setattr(neardup, "AGREE", 60)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**16, neardup.SKETCH, np.uint16)
    rows = [(bytes([k]), int(rng.integers(3)), int(rng.integers(1, 40)), np.where(rng.random(neardup.SKETCH) < 0.3, rng.integers(0, 2**16, neardup.SKETCH, np.uint16), base)) for k in range(80)]
    block = neardup._Block(rows)
    for cls, comp, n, sketch in rows:
        want = {x[0] for x in rows if x[1] != comp and 100 * min(n, x[2]) >= 75 * max(n, x[2]) and (x[3] == sketch).sum() >= 60}
        found, more = block.like(comp, n, sketch)
        assert {block.cls[i] for i in found} == want and not more
        found, more = block.like(comp, n, sketch, 2)
        assert {block.cls[i] for i in found} <= want and len(found) == min(2, len(want)) and more == (len(want) > 2)


# ---------------------------------------------------------------- decontamination


def passages(seed=1):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.randint(10, 60), 30_000))) for i in range(40)]
    rows, want = [], set()
    for d in range(300):
        w = words(rng, rng.randint(30, 300), 30_000)
        if d % 3 == 0:
            i, t = items[rng.randrange(40)]
            p = t.split()
            for k in rng.sample(range(len(p)), len(p) // 10):  # a tenth of the words replaced
                p[k] = f"z{rng.randrange(10**6)}"
            at = rng.randrange(len(w))
            w[at:at] = p
            want.add((d, i))
        rows.append((d, " ".join(w).capitalize()))
    return items, rows, want


def test_overlaps_with_substitutions(spark):
    items, rows, want = passages()
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, key long")
    got = {(r.doc_id, r.item_id) for r in decontam.find_overlaps(docs_of(spark, rows), bench).collect()}
    assert got == want
    left = decontam.decontaminate(docs_of(spark, rows), bench)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in want} and left.columns == docs_of(spark, rows).columns


def test_overlap_edges(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, None), (3, ""), (4, "a b"), (5, items_text := "Alpha, beta; gamma delta (epsilon) zeta eta theta iota kappa"),
             (6, items_text), (None, "x y z x y z x y z")]
    rows = [(1, "ONE two, three four five six seven eight nine ten eleven twelve!"), (2, None), (3, ""), (4, "a b"), (5, "beta gamma"),
            (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (7, "x y z x y z x y z"),
            (8, "one two three four five six seven eight"), (1, "ONE two, three four five six seven eight nine ten eleven twelve!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.start_word, r.n_words, r.n_equal) for r in decontam.find_overlaps(docs_of(spark, rows), bench).collect()), key=str)
    assert got == sorted([(1, 1, 0, 12, 12), (None, 5, 0, 10, 10)], key=str)
    assert decontam.find_overlaps(docs_of(spark, []), bench).count() == 0
    assert decontam.find_overlaps(docs_of(spark, rows), bench.limit(0)).count() == 0
    assert None not in {r.doc_id for r in decontam.decontaminate(docs_of(spark, rows), bench).collect()}


def test_short_items_with_a_substitution(spark):
    """Items of 5 to 9 words with any one word replaced, and with two replaced."""
    rng = random.Random(23)
    items, rows, want = [], [], set()
    for n in range(5, 10):
        w = words(rng, n, 10**9)
        items.append((n, " ".join(w)))
        for places in [(), *((k,) for k in range(n)), (0, n - 1)]:
            d = len(rows)
            rows.append((d, " ".join([*words(rng, 20, 10**9), *["z" if k in places else x for k, x in enumerate(w)], *words(rng, 9, 10**9)])))
            if len(places) < 2:
                want.add((d, n, 20, n, n - len(places)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontam.find_overlaps(docs_of(spark, rows), bench).select("doc_id", "item_id", "start_word", "n_words", "n_equal").collect()}
    assert got == want


def test_masks_hit_all_allowed_substitutions():
    import itertools

    for n in range(5, decontam.RUN + 1):
        masks = [decontam.ALL_MASKS[m] for m in decontam._item_masks(n)]
        hits = [{at + k for k in m} for m in masks for at in range(n - m[-1])]
        for gone in itertools.combinations(range(n), n - math.ceil(decontam.SHARE * n)):
            assert any(not h & set(gone) for h in hits), (n, gone)


# ---------------------------------------------------------------- line dedup


def line(rng, n):
    return " ".join(words(rng, n, 10**6))


def test_line_dedup(spark):
    rng = random.Random(4)
    p, q, short = line(rng, 60), line(rng, 55), "All rights reserved."
    parts = [line(rng, 12) for _ in range(4)]
    own = [line(rng, 40) for _ in range(9)]
    rows = [
        (1, "\n".join([own[0], p, own[1], short])),
        (2, "\n".join([own[2], q, short, "", p, own[3]])),  # p again
        (3, "\n".join([p, own[4], q])),  # both, in another order than in 2
        (4, "\r\n".join([own[5], *parts])),
        (5, "\n".join([*parts, own[6]])),  # a block of short lines, 48 words
        (6, "\n".join([parts[0], own[7], parts[1]])),  # short lines that are no block
        (7, "\n".join([own[8], p, p])),  # twice
        (8, rows1 := "\n".join([own[0], p, own[1], short])),  # a whole copy
        (9, None), (10, ""), (11, "\n\n"), (8, rows1), (None, q),
    ]
    got = defaultdict(list)
    for r in linededup.dedup_lines(docs_of(spark, rows).withColumn("gone", F.lit(1)).withColumn("n_lines", F.lit("x"))).collect():
        got[r.doc_id].append((r.text, r.n_deleted))
    assert got[1] == [(rows[0][1], 0)] and got[None] == [(q, 0)]
    assert got[2] == [("\n".join([own[2], short, "", own[3]]), 2)]  # q is in the row without id, which comes first
    assert got[3] == [(own[4] + "\n", 2)]
    assert got[4] == [(rows[3][1], 0)] and got[5] == [(own[6], 4)] and got[6] == [(rows[5][1], 0)]
    assert got[7] == [(own[8] + "\n", 2)]
    assert got[8] == [("", 4), ("", 4)] and got[9] == [(None, 0)] and got[10] == [("", 0)] and got[11] == [("\n\n", 0)]
    assert linededup.dedup_lines(docs_of(spark, [])).count() == 0


def test_patience_matches_are_a_common_subsequence():
    rng = random.Random(9)
    for _ in range(300):
        a = [rng.randrange(8) for _ in range(rng.randrange(12))]
        b = [rng.randrange(8) for _ in range(rng.randrange(12))]
        m = linededup.patience(a, b)
        assert all(a[i] == b[j] for i, j in m)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(m, m[1:]))


def test_line_dedup_keeps_a_first_holder(spark):
    rng = random.Random(8)
    pool = [line(rng, 35) for _ in range(12)]
    rows = [(d, "\n".join([line(rng, 5)] + rng.sample(pool, rng.randint(1, 5)))) for d in range(60)]
    out = {r.doc_id: r.text.split("\n") for r in linededup.dedup_lines(docs_of(spark, rows)).collect()}
    for x in pool:
        holders = [d for d, t in rows if x in t.split("\n")]
        assert [d for d in holders if x in out[d]] == holders[:1]


# ---------------------------------------------------------------- toxicity


def toxic_rows(seed=0, n=1500):
    rng = random.Random(seed)
    bad = ["blergo", "snivex", "crudo"]
    rows, labels = [], []
    for i in range(n):
        w = words(rng, rng.randint(5, 120), 800)
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w) + 1), rng.choice(bad) + rng.choice(["", "a", "s", "!"]))
        rows.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    truth = {i: any(b in t for b in bad) for i, t in rows}
    return rows, labels, truth


def test_toxicity_held_out(spark):
    rows, labels, truth = toxic_rows()
    docs = docs_of(spark, [*rows, (None, None), (-1, ""), (-2, "BLERG0 you"), (3, rows[3][1])])
    model = toxicity.fit_on_labels(docs, spark.createDataFrame(labels + [(4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= 0.5, truth[r.doc_id]) for r in got if r.doc_id is not None and r.doc_id >= 0 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) > 0.97
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()}
    assert np.mean([(i in kept) == (not t) for i, t in truth.items()]) > 0.97


def test_toxicity_held_out_labels_are_not_learned(spark):
    rows, labels, _ = toxic_rows(2, 300)
    docs = docs_of(spark, rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (toxicity.score(docs, toxicity.fit_on_labels(docs, spark.createDataFrame(x, schema))).orderBy("doc_id").collect() for x in (labels, flipped))
    assert [r.score for r in a] == [r.score for r in b]


def test_toxicity_rows_of_one_id_clashing_names_and_long_texts(spark):
    rows, labels, truth = toxic_rows(4, 600)
    bad, good = next(t for i, t in rows if truth[i]), next(t for i, t in rows if not truth[i])
    long = " ".join(good for _ in range(3000))
    extra = [(-5, bad), (-5, good), (-6, long), (-7, None)]
    docs = docs_of(spark, rows + extra)
    for name in ("score", "features", "text_hash", "bad_id", "raw", "prediction"):
        docs = docs.withColumn(name, F.lit(name))
    model = toxicity.fit_on_labels(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id in (-5, -6)").collect()) == [(-6, long), (-5, good)]


def test_toxicity_slices_change_nothing(monkeypatch):
    import pyarrow as pa

    lex = toxicity.make_lexicon(np.zeros(0, np.uint64), np.zeros(0))
    texts = pa.array(["You SHOUT! b4d w0rd", None, "", "fine text " * 500, "why? 12 %x"])
    whole = toxicity.features(texts, lex)
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    parts = [toxicity.features(b.column(0), lex) for b in textvec.slices([batch], 0, 30)]
    assert len(parts) > 1 and np.array_equal(np.concatenate(parts), whole)


@pytest.mark.parametrize("toxic,share", [(0, 0.0), (1, 1.0)])
def test_toxicity_one_class(spark, toxic, share):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(20)])
    labels = spark.createDataFrame([(i, 1, toxic) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit_on_labels(docs, labels)).collect()} == {share}
    none = toxicity.fit_on_labels(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), none).count() == 0


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    rows, labels, truth = toxic_rows(5, 600)
    p, item = line(rng, 60), line(rng, 25)
    base = words(rng, 200)
    extra = [(10_000, "\n".join([line(rng, 20), p])), (10_001, "\n".join([p, line(rng, 20)])), (10_002, " ".join(base)), (10_003, " ".join([*base[:100], "zz", *base[101:]])),
             (10_004, " ".join(base)), (10_005, line(rng, 30) + " " + item)]
    d = str(tmp_path)
    docs_of(spark, rows + extra).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.dtypes == docs.dtypes, name
        docs = out
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, d).collect()}
    assert 10_000 in got and 10_001 in got and 10_002 in got and not {10_003, 10_004, 10_005} & set(got)
    assert all(r.round_trip for r in got.values())
    clean = [i for i, t in truth.items() if not t]
    assert np.mean([i in got for i in clean]) > 0.97 and np.mean([i not in got for i, t in truth.items() if t]) > 0.95
