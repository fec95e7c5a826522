"""Merkle manifest of a dataset: a tree for each source, a tree over their roots, and a proof for every document.

Every leaf is the digest of a document's fields. In a tree every FAN consecutive nodes become their digest, level by level, until one is
left. The work is done in superblocks of FAN ** DEPTH nodes:

1. Leaves are range-partitioned by (tree, order); a sum a partition and tree gives every leaf its place in its tree, so a tree may be of any
   size and no task holds one.
2. Going up, each superblock is reduced to its root (DEPTH levels, or all levels of a tree that fits into one). Those roots are the nodes of the next
   tier, 1 / FAN ** DEPTH as many, until every tree is one node; then the same over the trees' roots.
3. Going down, the nodes of a superblock and the outer nodes that it needs (the siblings on the way from the superblock's root to the
   root of all) are cogrouped. ``applyInPandas`` finishes the local levels, joins them with the outer nodes to a proof of every node, and for leaves folds
   the digest that is claimed for the document with its proof.

What travels is digests: a leaf with its claim twice, and an outer row for each superblock.

Defined results: null fields have a digest of their own (``-``); a null source is a tree of its own, the first one; null doc_ids come first in their tree;
rows of one doc_id are ordered by digest, repeated rows are leaves of their own (their order changes no digest); an empty table gives an empty
manifest; columns that are not named are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.shared import parallelism, stored

FAN = 3
#: Levels of a superblock.
DEPTH = 7

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---------------------------------------------------------------- digests


def field_text(c: Column) -> Column:
    """``-`` of a null, else the value's length in bytes, a colon and the value."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def row_digest(fields: list[Column]) -> Column:
    """Lower-case hex SHA-256 of a row's fields."""
    return F.sha2(F.concat(*[field_text(c) for c in fields]), 256)


def tree_name(source: Column) -> Column:
    """Name of a source's tree; names sort as sources do, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _up(nodes: list[str]) -> list[str]:
    return [_digest("".join(nodes[k : k + FAN])) for k in range(0, len(nodes), FAN)]


def local_levels(total: int, depth: int) -> int:
    """Levels of a superblock in a tree of so many nodes: ``depth``, or as many as make the tree one node."""
    levels = 0
    while total > 1 and levels < depth:
        total, levels = -(-total // FAN), levels + 1
    return levels


# ---------------------------------------------------------------- places


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with pos (place of the row in its ``tree`` by ``order``, from 0) and total (rows of the tree)."""
    sort = ["tree", *order]
    ranged = rows.repartitionByRange(parallelism(rows.sparkSession), *sort).sortWithinPartitions(*sort)
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "ranges")  # task, then place in the sorted task
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    whole = Window.partitionBy("tree")  # a row for each range that holds rows of the tree
    parts = ranged.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = stored(parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("total")), "ranges")
    return ranged.join(parts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _by_block(nodes: DataFrame, depth: int):
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN**depth)).groupBy("tree", "block")


def _sorted(nodes: pd.DataFrame) -> pd.DataFrame:
    return nodes.iloc[np.argsort(nodes["pos"].to_numpy(), kind="stable")]


# ---------------------------------------------------------------- going up


def _block_roots(depth: int):
    def run(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        level, total = _sorted(nodes)["node"].tolist(), int(nodes["total"].iloc[0])
        for _ in range(local_levels(total, depth)):
            level = _up(level)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "total": [-(-total // FAN**depth)], "node": level})

    return run


def _tiers(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Tables of tree, pos, total, node: the nodes given, their superblocks' roots, and so on until every tree is one node."""
    tiers = [nodes]
    while True:
        widest = tiers[-1].agg(F.max("total")).first()[0]
        if widest is None or widest == 1:
            return tiers
        own = tiers[-1].select("tree", "pos", "total", "node")
        tiers.append(stored(_by_block(own, depth).applyInPandas(_block_roots(depth), "tree string, pos long, total long, node string"), "tier"))


# ---------------------------------------------------------------- going down

_OUTER = "tree string, block long, subroot string, root string, sibs array<string>, places array<int>"


def _paths(nodes: list[str], levels: int) -> tuple[list[list[str]], list[list[int]]]:
    """For every node of a superblock: its siblings (joined, left to right) and its place among them, level by level."""
    sibs: list[list[str]] = [[] for _ in nodes]
    places: list[list[int]] = [[] for _ in nodes]
    level, width = nodes, 1
    for _ in range(levels):
        for k in range(len(level)):
            start = k - k % FAN
            own = "".join(level[start:k] + level[k + 1 : start + FAN])
            for i in range(k * width, min((k + 1) * width, len(nodes))):
                sibs[i].append(own)
                places[i].append(k - start)
        level, width = _up(level), width * FAN
    return sibs, places


def fold(digest: str, sibs: list[str], places: list[int]) -> str:
    """The root that a digest and its proof give."""
    for own, at in zip(sibs, places):
        digest = _digest(own[: 64 * at] + digest + own[64 * at :])
    return digest


def _joined(nodes: pd.DataFrame, outer: pd.DataFrame, depth: int):
    """Proofs of a superblock's nodes up to the root of all: local levels, then the outer nodes."""
    if len(outer) != 1:
        raise ValueError("a superblock has one row of outer nodes")
    o = outer.iloc[0]
    sibs, places = _paths(nodes["node"].tolist(), local_levels(int(nodes["total"].iloc[0]), depth))
    more_sibs, more_places = list(o["sibs"]), list(o["places"])
    return [s + more_sibs for s in sibs], [p + more_places for p in places], o["subroot"], o["root"]


def _outer_of_blocks(depth: int):
    def run(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """Outer nodes of the superblocks whose roots these nodes are."""
        nodes = _sorted(nodes)
        sibs, places, subroot, root = _joined(nodes, outer, depth)
        named = "below" in nodes.columns  # the roots of whole trees
        return pd.DataFrame({
            "tree": nodes["below"].tolist() if named else [key[0]] * len(nodes),
            "block": [0] * len(nodes) if named else nodes["pos"].tolist(),
            "subroot": nodes["node"].tolist() if named else [subroot] * len(nodes),
            "root": [root] * len(nodes), "sibs": sibs, "places": places,
        })

    return run


_LEAVES = "doc_id long, has_id boolean, tree string, pos long, leaf string, subroot string, root string, proof array<string>, places array<int>, folded_root string"


def _leaf_proofs(depth: int):
    def run(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = _sorted(leaves)
        sibs, places, subroot, root = _joined(leaves, outer, depth)
        return pd.DataFrame({
            "doc_id": leaves["doc_id"].to_numpy(), "has_id": leaves["has_id"].to_numpy(), "tree": key[0], "pos": leaves["pos"].to_numpy(),
            "leaf": leaves["node"].to_numpy(), "subroot": subroot, "root": root, "proof": sibs, "places": places,
            "folded_root": [fold(c, s, p) for c, s, p in zip(leaves["claim"].tolist(), sibs, places)],
        })

    return run


def _descend(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    return stored(_by_block(nodes, depth).cogroup(outer.groupBy("tree", "block")).applyInPandas(_outer_of_blocks(depth), _OUTER), "outer")


def manifest(docs: DataFrame, leaf: Column, claim: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """doc_id, source tree, place, leaf, subroot, root, proof (siblings joined left to right, a text for each level from the leaf to the root of all),
    places (of the node among them) and folded_root of every row. ``leaf`` is the digest that goes into the tree, ``claim`` the one that is folded with
    the row's proof (the leaf itself where it is not given); ``depth`` is that of the superblocks and changes no digest."""
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("id"), tree_name(F.col("source")).alias("tree"), leaf.alias("node"),
        (leaf if claim is None else claim).alias("claim"),
    )
    low = placed(stored(leaves, "leaves"), ["id", "node"])
    low = stored(low.select("tree", "pos", "total", "node", "claim", F.coalesce("id", F.lit(0)).alias("doc_id"), F.col("id").isNotNull().alias("has_id")), "leaves")
    tiers = _tiers(low, depth)
    roots = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("below"), "node")
    top = stored(placed(roots, ["below"]), "roots")
    over = _tiers(top, depth)
    outer = over[-1].select(
        "tree", F.lit(0).cast("long").alias("block"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"),
        F.array().cast("array<string>").alias("sibs"), F.array().cast("array<int>").alias("places"),
    )
    for nodes in [*reversed(over[:-1] or over), *reversed(tiers[1:-1])]:
        outer = _descend(nodes, outer, depth)
    out = _by_block(low, depth).cogroup(outer.groupBy("tree", "block")).applyInPandas(_leaf_proofs(depth), _LEAVES)
    return out.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).drop("has_id")


SQL = r"""
with recursive d as (
  select row_number() over () rid, doc_id, source, coalesce('s' || source, 'n') tree,
    coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-') head,
    text, list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''),
      lambda c: list_transform(range(8), lambda b: ((ascii(c) >> b::int) & 1)::bigint)))) bits
  from documents),
leaves as (
  select rid, doc_id, tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) leaf,
    sha256(head || coalesce(octet_length(encode(t2)) || ':' || t2, '-')) claim
  from (select *, case when xor(list_reduce(bits, lambda c, b: xor(c >> 1, 3988292384 * xor(c & 1, b))), 4294967295) & 1 = 0
               then replace(text, chr(10), '') else text end t2 from d) x),
first as (select tree, 0 lvl, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 pos, leaf node, rid from leaves),
low as (
  select tree, lvl, pos, node from first
  union all
  select tree, lvl + 1, pos // 3, sha256(string_agg(node, '' order by pos))
  from (select *, count(*) over (partition by tree) c from low) x where c > 1 group by tree, lvl, pos // 3),
subroots as (select tree, node from low qualify lvl = max(lvl) over (partition by tree)),
top as (
  select 0 lvl, row_number() over (order by encode(tree)) - 1 pos, node from subroots
  union all
  select lvl + 1, pos // 3, sha256(string_agg(node, '' order by pos)) from (select *, count(*) over () c from top) x where c > 1 group by lvl, pos // 3),
root as (select node root from top where lvl = (select max(lvl) from top)),
named as (select tree, node, row_number() over (order by encode(tree)) - 1 pos from subroots),
low_n as (select tree, lvl, count(*) n from low group by all),
top_n as (select lvl, count(*) n from top group by all),
walk as (
  select rid, tree, 0 stage, 0 lvl, pos, '' proof, claim acc from first join leaves using (rid, tree)
  union all
  select w.rid, w.tree, case when last then 1 else w.stage end, case when last then 0 else w.lvl + 1 end,
    case when last then tp else w.pos // 3 end, w.proof || coalesce(l, '') || coalesce(r, ''),
    case when last then acc else sha256(coalesce(l, '') || acc || coalesce(r, '')) end
  from (
    select w.*, n.n = 1 last, nm.pos tp,
      case when n.n > 1 then (select string_agg(node, '' order by s.pos) from low s where s.tree = w.tree and s.lvl = w.lvl and s.pos // 3 = w.pos // 3 and s.pos < w.pos) end l,
      case when n.n > 1 then (select string_agg(node, '' order by s.pos) from low s where s.tree = w.tree and s.lvl = w.lvl and s.pos // 3 = w.pos // 3 and s.pos > w.pos) end r
    from walk w join low_n n on n.tree = w.tree and n.lvl = w.lvl join named nm on nm.tree = w.tree where w.stage = 0
    union all
    select w.*, false, null,
      (select string_agg(node, '' order by s.pos) from top s where s.lvl = w.lvl and s.pos // 3 = w.pos // 3 and s.pos < w.pos),
      (select string_agg(node, '' order by s.pos) from top s where s.lvl = w.lvl and s.pos // 3 = w.pos // 3 and s.pos > w.pos)
    from walk w join top_n n on n.lvl = w.lvl where w.stage = 1 and n.n > 1) w),
done as (select rid, arg_max(proof, stage * 1000 + lvl) proof, arg_max(acc, stage * 1000 + lvl) acc from walk group by rid)
select doc_id, leaf, s.node subroot, root, sha256(proof) proof_sha256, acc folded_root, acc = root verified
from leaves join subroots s using (tree) join done using (rid), root
"""
