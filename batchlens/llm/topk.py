"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are scaled to integers, ``floor(scale * x)``, so scores are exact integers. Rows are dealt evenly over shards of
about SHARD_ROWS rows. A shard's KD-tree splits at the median of the widest dimension and keeps the tight bounding box
of every node; no vector x of a box [lo, hi] scores more than sum(max(q * lo, q * hi)) against query q. A query walks
the tree best bound first and ends where the bound is under its k-th score so far. That k-th score is propagated: every
block of queries first visits one shard, which its hash picks, and the k-th scores found there are the floor with which the other shards are
searched. Queries go to shards in blocks by generated shard numbers; a shard that more than about TASK_QUERIES queries visit is sent to
several tasks, each with a part of the queries; each shard answers with k rows a query.

Defined results: rows whose id or vector is null or empty, or holds null, NaN or infinite components, take no part;
vectors meet only those of the same length; ties go to the smaller id; repeated rows are candidates each; rows with the
query's own id are never its candidates; a repeated query id asks once, with its smallest vector; a query with fewer
than k candidates gets all; empty tables give empty results; other columns are not looked at. Scores are exact as long
as they fit into 63 bits.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.shared import parallelism, stored

SHARD_ROWS = 8192
QUERY_ROWS = 256
TASK_QUERIES = 4096
LEAF_ROWS = 64

_SENT = ["shard", "salt", "dim", "kind", "ids", "vecs", "floors"]
_BLOCK = "shard int, dim int, kind int, ids array<bigint>, vecs binary, floors binary"
_HIT = "query_id long, vec_id long, score long"


class KDTree:
    """Median splits of the widest dimension, with tight boxes."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray):
        order = np.arange(len(ids))
        self.lo, self.hi, self.kids, self.rows = [], [], [], []
        self._build(vecs, order, 0, len(ids))
        self.order, self.ids, self.vecs = order, ids[order], vecs[order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _build(self, vecs, order, a, b) -> int:
        node = len(self.kids)
        part = vecs[order[a:b]]
        lo, hi = part.min(0), part.max(0)
        self.lo.append(lo)
        self.hi.append(hi)
        self.kids.append(None)
        self.rows.append((a, b))
        if b - a > LEAF_ROWS and (hi > lo).any():
            mid = (b - a) // 2
            at = np.argpartition(part[:, int(np.argmax(hi - lo))], mid)
            order[a:b] = order[a:b][at]
            self.kids[node] = (self._build(vecs, order, a, a + mid), self._build(vecs, order, a + mid, b))
        return node

    def search(self, qids: np.ndarray, qvecs: np.ndarray, k: int, floors: np.ndarray):
        """(query, id, score) of up to k rows a query that score at least its floor."""
        bounds = np.maximum(qvecs, 0) @ self.hi.T + np.minimum(qvecs, 0) @ self.lo.T
        for i, (qid, q) in enumerate(zip(qids, qvecs)):
            bound, floor = bounds[i], floors[i]
            ids, scores = np.zeros(0, np.int64), np.zeros(0, q.dtype)
            heap = [(-bound[0], 0)]
            while heap:
                b, node = heapq.heappop(heap)
                if -b < floor:
                    break
                if kids := self.kids[node]:
                    for kid in kids:
                        if bound[kid] >= floor:
                            heapq.heappush(heap, (-bound[kid], kid))
                    continue
                at, end = self.rows[node]
                s = self.vecs[at:end] @ q
                good = np.flatnonzero((s >= floor) & (self.ids[at:end] != qid))
                if len(good):
                    ids, scores = np.concatenate((ids, self.ids[at:end][good])), np.concatenate((scores, s[good]))
                    if len(ids) >= k:
                        best = np.lexsort((ids, -scores))[:k]
                        ids, scores = ids[best], scores[best]
                        floor = max(floor, scores[-1])
            if len(ids):
                yield qid, ids, scores


def _pack(kind: int, most: int):
    """Rows (shard, id, vec) of a partition into packed blocks of one dimension and up to ``most`` rows."""

    def emit(shard, dim, rows):
        ids = np.array([r[0] for r in rows], np.int64)
        vecs = np.array([r[1] for r in rows], np.int64)
        return pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "dim": pa.array([dim], pa.int32()), "kind": pa.array([kind], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())), "vecs": [vecs.tobytes()], "floors": pa.array([None], pa.binary())}
        )

    def run(batches):
        held: dict = {}
        for b in batches:
            for shard, i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                rows = held.setdefault((shard, len(v)), [])
                rows.append((i, v))
                if len(rows) >= most:
                    yield emit(shard, len(v), held.pop((shard, len(v))))
        for (shard, dim), rows in held.items():
            yield emit(shard, dim, rows)

    return run


def _answer(k: int):
    """Blocks sorted by (shard, salt, dim, kind): the rows' block comes first, then the queries' blocks."""

    def run(batches):
        key = tree = rows = None
        for b in batches:
            for r in b.to_pylist():
                ids = np.array(r["ids"], np.int64)
                vecs = np.frombuffer(r["vecs"], np.int64).reshape(len(ids), r["dim"])
                here = (r["shard"], r["salt"], r["dim"])
                if r["kind"] == 0:
                    if here == key:  # another block of the same shard
                        rows = (np.concatenate((rows[0], ids)), np.concatenate((rows[1], vecs)))
                    else:
                        key, rows = here, (ids, vecs)
                    tree = None
                    continue
                if here != key:
                    continue
                # float64 products are exact while sums stay under 2^53; int64 beyond
                top = float(np.abs(rows[1]).max(initial=0)) * float(np.abs(vecs).max(initial=0)) * max(1, r["dim"])
                kind = np.float64 if top < 2**53 else np.int64
                if tree is None or tree.vecs.dtype != kind:
                    tree = KDTree(rows[0], rows[1].astype(kind))
                floors = np.frombuffer(r["floors"], np.int64) if r["floors"] is not None else np.full(len(ids), -(2**62))
                found = list(tree.search(ids, vecs.astype(kind), k, floors))
                if found:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "query_id": np.concatenate([np.full(len(n), q, np.int64) for q, n, _ in found]),
                            "vec_id": np.concatenate([n for _, n, _ in found]),
                            "score": np.concatenate([s for _, _, s in found]).astype(np.int64),
                        }
                    )

    return run


def _floors(k: int):
    """Query blocks joined with their queries' k-th scores so far."""

    def run(batches):
        for b in batches:
            out = b.to_pylist()
            for r in out:
                at = {q: s for q, s in zip(r.pop("q") or [], r.pop("s") or [])}
                r["floors"] = np.array([at.get(i, -(2**62)) for i in r["ids"]], np.int64).tobytes()
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("vecs", pa.binary()), ("floors", pa.binary())]))

    return run


def valid_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, vec array<bigint>) of the rows that take part."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    return df.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("vec"))


def top_k(rows: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``rows``: (vec_id, vec) of ``valid_vectors``; ``is_query`` picks the queries. Returns query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    cols = ["shard", "vec_id", "vec"]
    dealt = rows.repartition(shards).withColumn("shard", F.spark_partition_id()).select(*cols)
    blocks = stored(dealt.mapInArrow(_pack(0, SHARD_ROWS * 2), _BLOCK), "topk-shards")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    packed = asked.select(F.lit(0).alias("shard"), "vec_id", "vec").mapInArrow(_pack(1, QUERY_ROWS), _BLOCK)
    queries = stored(packed.select(F.xxhash64("ids").alias("block"), "dim", "ids", "vecs", "floors"), "topk-queries")

    n_queries = queries.agg(F.sum(F.size("ids"))).first()[0] or 0
    home = F.pmod("block", F.lit(shards)).cast("int")

    def visit(qs: DataFrame, at: Column, visits: int) -> DataFrame:
        """Every query block at its shards ``at``; ``visits`` is the number of queries over all shards."""
        salts = max(1, -(-visits // (shards * TASK_QUERIES)))
        salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")
        sent = qs.select(F.explode(at).alias("shard"), salt.alias("salt"), "dim", F.lit(1).alias("kind"), "ids", "vecs", "floors")
        here = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(*_SENT)
        tasks = max(shards, min(shards * salts, 4 * parallelism(spark)))
        both = here.unionByName(sent).repartition(tasks, "shard", "salt").sortWithinPartitions("shard", "salt", "dim", "kind")
        return both.mapInArrow(_answer(k), _HIT)

    seen = stored(visit(queries, F.array(home), n_queries), "topk-first")
    if shards > 1:
        kth = (
            seen.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") >= k)
        )
        member = queries.select("block", F.explode("ids").alias("query_id"))
        per_block = member.join(kth, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "s")).alias("f"))
        told = queries.drop("floors").join(per_block, "block", "left").select(
            "block", "dim", "ids", "vecs", F.col("f.query_id").alias("q"), F.col("f.s").alias("s")
        )
        floors = told.mapInArrow(_floors(k), "block long, dim int, ids array<bigint>, vecs binary, floors binary")
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)
        seen = seen.unionByName(visit(floors, others, n_queries * (shards - 1)))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return seen.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: DuckDB SQL for queries whose id is divisible by 100, 10 best, scale 1024.
SQL = """
with v as (
  select cast(vec_id as bigint) vec_id, len(embedding) dim, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) score
  from v q join v c on c.dim = q.dim and c.vec_id <> q.vec_id where q.vec_id % 100 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""
