import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from batchlens.llm import chat, topk, warc
from batchlens.llm.shared import stored

# ---------------------------------------------------------------- chat

CHAT = "conv_id long, turn long, role string, text string, formatted string"


def _chat(spark, rows):
    return {r.conv_id: r for r in chat.digests(chat.read_chat(stored(chat.format_chat(spark.createDataFrame(rows, CHAT)), "t"))).collect()}


def _brute(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, rs in out.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in rs if r[2] == "assistant")
        out[c] = (len(rs), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rs)), len(loss), sha(loss))
    return out


def test_chat_round_trip(spark):
    nasty = ["", None, "</turn>\n### user:\n", "<part/>", "&lt;", "&amp;lt;", "a\n\nb", "### assistant:\nx", "\\", "ünï 🤦", "&num;#", "&"]
    rows = []
    rng = random.Random(3)
    for c in range(30):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a:b\nc", None]), rng.choice(nasty), "x"))
    rows += [(None, 1, "assistant", "no id", ""), (None, 0, "user", None, "")]
    rows += [(99, 5, "assistant", "b", ""), (99, 5, "assistant", "a", ""), (99, 5, "assistant", "a", ""), (99, None, "user", "first", "")]
    got, want = _chat(spark, rows), _brute(rows)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == want


def test_chat_long_conversation_keeps_one_header_a_block(spark):
    n = 3 * chat.SLICE + 7  # blocks that run over the slices' ends
    rows = [(1, t, "user" if t < 300 else "assistant", f"t{t}<", "") for t in range(n)]
    got, want = _chat(spark, rows), _brute(rows)
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == want[1]
    text = chat.format_chat(spark.createDataFrame(rows, CHAT)).first().formatted
    assert text.count("### ") == 2 and text.count(chat.END) == 2


def test_chat_empty_table(spark):
    assert _chat(spark, []) == {}


# ---------------------------------------------------------------- top-k


def _topk(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, shard string")
    v = topk.valid_vectors(df, "vec_id", "embedding", 1024)
    return sorted(tuple(r) for r in topk.top_k(v, F.col("vec_id") % 100 == 0, k).collect())


def _topk_brute(rows, k=10):
    ok = [(i, [int(np.floor(float(np.float32(x)) * 1024)) for x in v]) for i, v, *_ in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in ok:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, qv in asked.items():
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:k])]
    return sorted(out)


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 200)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)], "r", "s") for i in range(700)]
    rows += [(1000 + i, [0.5] * 6, "", "") for i in range(30)]  # ties
    rows += [(200, [0.1] * 6, "", ""), (200, [0.1] * 6, "", ""), (3, [9.0] * 6, "", ""), (3, [9.0] * 6, "", "")]  # repeated rows
    rows += [(2000, [1.0, 2.0], "", ""), (2001, [1.0, 1.0], "", ""), (2100, [], "", ""), (2200, None, "", ""), (None, [1.0] * 6, "", "")]
    rows += [(2300, [1.0, None, 1.0, 1.0, 1.0, 1.0], "", ""), (2400, [float("nan")] * 6, "", ""), (2500, [float("inf")] * 6, "", "")]
    assert _topk(spark, rows) == _topk_brute(rows)


def test_topk_queries_spread_over_tasks(spark, monkeypatch, tmp_path):
    """No task searches a large part of the queries' visits, and results stay whole."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 500)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    monkeypatch.setattr(topk, "TASK_QUERIES", 64, raising=False)
    place, answer = str(tmp_path), topk._answer

    def noted(k):
        def run(batches):
            from pyspark import TaskContext

            def seen():
                for b in batches:
                    n = sum(len(i) for i, kind in zip(b.column("ids").to_pylist(), b.column("kind").to_pylist()) if kind == 1)
                    with open(f"{place}/{TaskContext.get().stageId()}-{TaskContext.get().partitionId()}", "a") as f:
                        f.write(f"{n}\n")
                    yield b

            yield from answer(k)(seen())

        return run

    monkeypatch.setattr(topk, "_answer", noted)
    rng = np.random.default_rng(5)
    rows = [(i * 50, [float(x) for x in rng.normal(size=4)], "", "") for i in range(2000)]  # 1,000 queries, 4 shards
    assert _topk(spark, rows) == _topk_brute(rows)
    stages = {}
    for f in tmp_path.iterdir():
        stages.setdefault(int(f.name.split("-")[0]), []).append(sum(map(int, f.read_text().split())))
    visits = [sorted(n) for _, n in sorted(stages.items())]
    assert [sum(n) for n in visits] == [1000, 3000] and visits[0][-1] <= 500 and visits[1][-1] <= 750, visits


def test_topk_few_and_empty(spark):
    assert _topk(spark, []) == []
    rows = [(100, [1.0, 0.0], "", ""), (1, [2.0, 0.0], "", "")]
    assert _topk(spark, rows) == [(100, 1, 1, 2048 * 1024)]


# ---------------------------------------------------------------- WARC

PAGES = "page_id long, url string, html string, digest string, salt string, shard string"


def _warc(spark, rows, **kw):
    root = warc.new_root(spark)
    m = warc.write_warc(spark.createDataFrame(rows, PAGES), root, **kw)
    return m, root


def test_warc_round_trip_and_roles(spark):
    big = "x" * 1200
    rows = [(1, "http://a/1", big, "", "", ""), (2, "http://a/ü b", big, "", "", ""), (2, "http://a/2", big, "", "", ""), (None, None, big, "", "", "")]
    rows += [(5, "u", "small", "", "", ""), (6, "u", "small", "", "", ""), (7, None, None, "", "", ""), (8, "a\r\nb: c", "é\r\n\r\nWARC/1.1", "", "", "")]
    rows += [(9, "u", "y" * 999, "", "", ""), (10, "u", "y" * 999, "", "", ""), (11, "u", "z" * 1000, "", "", ""), (12, "u", "z" * 1000, "", "", "")]
    m, root = _warc(spark, rows)
    got = sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload) for r in warc.read_warc(m, root, True).collect()), key=str)
    want = []
    for p, u, h, *_ in rows:
        data = (h or "").encode()
        top = {1200: 2, 1000: 12}.get(len(data))
        revisit = top is not None and p != top
        want.append((p, u, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None, None if revisit else bytearray(data)))
    assert got == sorted(want, key=str)


def test_warc_rolls_and_repeats_byte_for_byte(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("abcdefghij") for _ in range(3000)), "", "", "") for i in range(60)]
    a, _ = _warc(spark, rows, roll_bytes=20_000)
    b, _ = _warc(spark, rows[::-1], roll_bytes=20_000)
    files = lambda m: sorted((r.name, r.n_bytes, r.sha1, r.n_records) for r in m.collect())
    assert files(a) == files(b) and len(files(a)) > 3 and all(f[1] <= 20_000 for f in files(a))


def test_warc_empty_table(spark):
    m, root = _warc(spark, [])
    assert m.count() == 0 and warc.read_warc(m, root).count() == 0


def test_warc_of_uneven_ids(spark, monkeypatch):
    """Dense page ids beside a far one, a repeated one and null ones go to shards of bounded size; records are those of one shard."""
    ids = [*range(200), *[100] * 80, *[None] * 80, 2**62, -5]
    rows = [(i, f"http://x/{k}", f"{k % 150:04d}" * 300) for k, i in enumerate(ids)]  # payloads of 1,200 bytes, many of them twice
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {}
    for size in (20 * 1712, 1 << 40):
        monkeypatch.setattr(warc, "SHARD_BYTES", size)
        root = warc.new_root(spark)
        manifest = warc.write_warc(df, root)
        most = manifest.groupBy("shard").agg(F.sum("n_records").alias("n")).agg(F.max("n")).first()[0]
        out[size] = (most, sorted((tuple(r) for r in warc.read_warc(manifest, root).collect()), key=str))
    (few, got), (whole, want) = out.values()
    assert whole == len(rows) and got == want and few <= 40, few
