import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from batchlens.llm import idfiles, pieces, shared, textvec, tokens
from batchlens.llm.queries import tokenizer

WORD = tokenizer("word_bpe_49k.json")
PIECE = tokenizer("piece_bpe_32k.model")
ODD = ["", " ", "\n", "a", "Hello World's it'll", "<|endoftext|> x<|startoftext|>", "é é Å", "a b c\x1cd\x85e", "１２3٣", "日本語テキスト", "🤦🏼‍♂️ ok",
       "tab\there\r\nnext", "  two  spaces  ", "x" * 300, "''''s't", "İSTANBUL ΣΑΣ", "\x00\x01", "▁mark"]


def _texts(n=60, seed=1):
    rng = random.Random(seed)
    words = ODD + ["the", "of", "tion", "12", "3.14", "don't", "naïve", "-", "(a)", "https://x.y/z?q=1"]
    return ODD + ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "", "  "]) for _ in range(rng.randint(1, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def piece_library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


def _ids(library, t):
    return library.encode(t or "", add_special_tokens=False).ids


def test_table_of_parts_equals_library(library):
    e = tokens.Encoder(WORD)
    texts = [*_texts(300), None, "don't.'x' a.b,c--d 'quoted' it's'", "The THE the tHe.", "<|endoftext|", "x<|endoftext|>y"]
    for _ in range(2):  # learned, then looked up
        ids, bounds = e.column(pa.array(texts))
        for t, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == _ids(library, t), repr(t)


def test_table_parts_that_share_a_slot(library, monkeypatch):
    monkeypatch.setattr(tokens.Table, "SLOTS", 4)
    monkeypatch.setattr(tokens, "TABLE_PARTS", 50)  # starts anew again and again
    e = tokens.Encoder(WORD)
    for k in range(4):
        texts = _texts(30, k)
        assert e.counts(pa.array(texts)).tolist() == [len(_ids(library, t)) for t in texts]


def test_spliced_chunks_equal_library(library):
    e = tokens.Encoder(WORD)
    rng = random.Random(5)
    for k in range(12):
        t = "".join(rng.choice(_texts(5, k)) for _ in range(40))
        for chunk, overlap in ((64, 16), (200, 8), (500, 100)):
            assert e.long(t, chunk, overlap).tolist() == _ids(library, t)


def test_no_boundary_widens_to_the_whole(library):
    e = tokens.Encoder(WORD)
    for t in ("x" * 3000, "日本語" * 500, "é!" * 700, "a" + "́" * 900, "<|endoftext|>" * 90, "word " + "y" * 2000 + " end " * 50):
        assert e.long(t, 100, 10).tolist() == _ids(library, t)


def test_count_tokens(spark, library):
    texts = _texts(20) + [None, None, "word " * 9000]
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts)] + [(1, "again", "x"), (1, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(df, WORD, 2048).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), n := len(_ids(library, t)), n > 2048) for i, t, _ in rows), key=str)
    assert got == want
    assert tokens.count_tokens(df.limit(0), WORD).count() == 0


def test_pieces_equal_library(piece_library):
    m = pieces.Pieces(PIECE)
    texts = _texts(200, 7) + [" " * 40, "   x" * 9, "a" * 200, "<0x0A>", "<s></s><unk>"]
    for t, got in zip(texts, m.encode(texts)):
        assert got == piece_library.encode(t), repr(t)
        assert m.decode(got) == piece_library.decode(got)
    for _ in range(2):  # learned, then looked up
        ids, bounds = m.column(pa.array([*texts, None]))
        for t, a, b in zip([*texts, ""], bounds, bounds[1:]):
            assert ids[a:b].tolist() == piece_library.encode(t), repr(t)


def test_pieces_share_prefixes(piece_library):
    m = pieces.Pieces(PIECE)
    rng = random.Random(2)
    words = {"▁" + "".join(rng.choice("abcdeéióun") for _ in range(rng.randint(1, 14))) for _ in range(3000)}
    got = m.forward(list(words))
    assert all(list(got[w]) == piece_library.encode(w[1:]) for w in words)


def test_forward_pass_looks_up_no_substrings(piece_library, monkeypatch):
    """Steps of the automaton are worked out once; after that a character costs no look-ups among the pieces. Forgetting steps changes nothing."""

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

    m = pieces.Pieces(PIECE)
    m.id = Counted(m.id)
    rng = random.Random(8)
    found = [f"{pieces.MARK}{''.join(rng.choices('abcdeinorst', k=rng.randint(1, 12)))}" for _ in range(300)] + [pieces.MARK + "naïve☃", "größer", "\n"]
    want = m.forward(found)
    assert {w: list(x) for w, x in want.items()} == {w: piece_library.encode(w[1:]) for w in found[:301]} | {w: list(want[w]) for w in found[301:]}
    Counted.asked = 0
    assert m.forward(found) == want and Counted.asked < 100  # pairs that share a place are asked again
    monkeypatch.setattr(pieces, "STEPS", 5)
    assert pieces.Pieces(PIECE).forward(found) == want


def test_encode_pieces_table(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, "x"), (3, "", "x"), (4, "ü\n ▁", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = pieces.encode_pieces(df, PIECE)
    got = {r.doc_id: r for r in out.collect()}
    assert got[3].n_pieces == 0 and got[None].n_pieces == 0 and got[1].round_trip and not got[4].round_trip
    assert sorted(r.text for r in pieces.decode_pieces(out, PIECE).collect()) == sorted(["a b", "a b", "", "", "ü\n  "])
    assert pieces.encode_pieces(df.limit(0), PIECE).count() == 0


def test_block_coding():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        r = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = idfiles.encode_block(r)
        assert len(control) == -(-n // 4) and (idfiles.decode_block(control, data, n) == r).all()


def test_id_files(spark, library, monkeypatch):
    monkeypatch.setattr(idfiles, "SHARD_BYTES", 3000)
    monkeypatch.setattr(idfiles, "BLOCK", 100)
    texts = _texts(40, 3) + [None, "same", "same"]
    rows = [(i * 10, t, 1) for i, t in enumerate(texts)] + [(50, "tie", 1), (50, "tie", 1), (None, "no id", 1), (10**12, "far", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    root = idfiles.new_root(spark)
    manifest = idfiles.write_ids(df, WORD, 1, root)
    got = [tuple(r) for r in idfiles.read_ids(manifest, root).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    want = sorted((i if i is not None else -1, len(x := _ids(library, t) + [1]), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t, _ in rows)
    assert sorted((g[0] if g[0] is not None else -1, g[2], g[3]) for g in got) == want
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    assert manifest.count() > 1


def test_id_files_of_uneven_ids(spark, monkeypatch):
    """Dense ids beside far ones, a repeated id and null ids go to files of bounded size, in order."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(idfiles, "SHARD_BYTES", 3000)  # about 40 rows
    ids = [*range(300), *[150] * 100, *[None] * 100, 2**62, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(i, f"text {k:06d}") for k, i in enumerate(ids)], "doc_id long, text string")
    root = idfiles.new_root(spark)
    manifest = idfiles.write_ids(df, WORD, 1, root)
    assert max(r.n_docs for r in manifest.collect()) <= 60 and manifest.count() < 40
    got = [r.doc_id for r in idfiles.read_ids(manifest, root).orderBy("start").collect()]
    assert got == sorted(ids, key=lambda i: (i is not None, i))
    for rows in (df.where("doc_id is null"), df.where("doc_id = 150"), df.where("doc_id = 2")):
        few = idfiles.write_ids(rows, WORD, 1, one := idfiles.new_root(spark))
        with monkeypatch.context() as m:
            m.setattr(idfiles, "SHARD_BYTES", 1 << 30)
            whole = idfiles.write_ids(rows, WORD, 1, other := idfiles.new_root(spark))
        assert whole.count() == 1 and few.count() == -(-rows.select(F.sum(F.octet_length("text") + 64)).first()[0] // 3000)
        assert idfiles.read_ids(few, one).orderBy("start").collect() == idfiles.read_ids(whole, other).orderBy("start").collect()


def test_id_files_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    root = idfiles.new_root(spark)
    assert idfiles.read_ids(idfiles.write_ids(df, WORD, 1, root), root).count() == 0


# ---------------------------------------------------------------- memory of a worker


def test_texts_reach_workers_in_small_batches(spark):
    """20 MB of texts in one partition: no batch holds more than the bound and one row, and the ids are those of the single texts."""
    spark.conf.unset(shared.BATCH_CONF)
    df = spark.createDataFrame([(i, "word number " * 4200) for i in range(400)], "doc_id long, text string").coalesce(1)
    out = pieces.encode_pieces(df, PIECE)

    def batch_bytes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    sizes = [r.n for r in df.mapInArrow(batch_bytes, "n long").collect()]
    assert sum(sizes) > 20e6 and max(sizes) < shared.BATCH_BYTES + 200_000
    got = out.groupBy("ids").count().collect()
    assert len(got) == 1 and got[0]["count"] == 400 and got[0]["ids"] == pieces.model(PIECE).encode(["word number " * 4200])[0]
    spark.conf.set(shared.BATCH_CONF, "1m")  # a session's own bound stays
    pieces.encode_pieces(df, PIECE)
    assert spark.conf.get(shared.BATCH_CONF) == "1m"
    spark.conf.unset(shared.BATCH_CONF)


def test_slices_release_what_they_took(monkeypatch):
    calls = []
    monkeypatch.setattr(textvec, "release", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 100] * 10})
    parts = list(textvec.slices([batch], 0, 250))
    assert sum(p.num_rows for p in parts) == 10 and len(calls) == len(parts) == 5
