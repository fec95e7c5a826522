"""Near-duplicate groups by a chosen-path set similarity join.

A document's set is its distinct 5-word shingles. Documents with equal sets are one *class* from the start, so groups of exact
copies of any size are one row. Every class has TREES minwise tokens (one for each hash function) and a sketch of SKETCH
further minwise values.

- A tree starts from one minwise token: classes that agree on it are a node. TREES trees are grown, each from a minwise function of
  its own, so a pair at the threshold misses all roots with probability (1 - t) ** TREES, which is 6e-8 at 0.75.
- First links: in every node all classes are tried against the node's most popular class only (its *center*: the one whose tokens
  most other classes share, the text that a group was copied from). Confirmed links put classes into components; nothing
  inside one component has to be compared again, so a group of thousands of near copies costs about one link a member.
- Families: for every class at least FAMILY percent similar to a center, what it lacks of the center's set and what it has beside it is
  kept from that comparison. Two members' intersection follows from these differences exactly, so the members that are not
  linked with the center are compared with all members of the family, in blocks, without their sets; a block reports only
  links that join two components.
- Chosen paths: nodes that still hold more than one component and a class outside their center's family are taken further. Nodes of more
  than LEAF classes and FEW outside ones branch: every class goes on to BRANCH children, named by its values of BRANCH minwise functions that only this
  tree and depth use (no two trees or depths share one). Children branch again, down to DEPTH. A pair at similarity t stays together in
  a tree that branches all the way with probability t * (1 - (1 - t) ** BRANCH) ** DEPTH, 0.58 at 0.75, so TREES independent trees miss
  it with probability 3e-5 (about 0 at 0.9). Trees that stop earlier miss less.
- Small nodes (at most LEAF classes) are compared exhaustively. A child that keeps more than DENSE of its parent holds classes too similar for
  branching to part them; it, a node with at most FEW classes outside the family, and what is large at DEPTH, is closed and compared in
  tiles, the classes outside the family against all.
  A tile leaves out pairs of one family, whatever node its center was found in: these have been compared. It offers every class its LIMIT
  most similar classes of other components and says where it has more; confirmed links join components. If more than FEW
  classes have more, every node gets a new center, the most popular of them that has been none, and so further families. Classes with more come again with a
  limit eight times as high, until none has more. So a group of similar classes costs a few pairs a class, linked or not, and no
  candidate is left untried but inside a component.
- Pairs out of these nodes are confirmed on the full sets: 100 * intersection >= 75 * union. Before that only pairs are left out
  whose sizes rule the threshold out, or that agree on fewer than AGREE of SKETCH values (probability 1e-7 at the threshold).

Full sets are computed again from the texts, for the classes that occur in a pair only, and travel to the pair's first class,
which a task holds while the others stream by.

Defined results: null and empty texts, and texts without words, have no shingles and are linked with nothing; texts of one to four words have
one; rows with one doc_id are one node; a null doc_id takes no part (component_id null, kept true); an empty table gives an
empty one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm import textvec
from batchlens.llm.shared import bloom, bloom_mask, small_batches, stored

WIDTH = 5
PERCENT = 75
TREES = 12
SKETCH = 128
AGREE = 70
#: Tokens that a first link's classes share; pairs with fewer are left to the comparison of all.
FIRST_AGREE = 3
#: Least similarity (percent) of a family's members with its center.
FAMILY = 35
LEAF = 32
#: Outside classes up to which a large node is compared as it is: no class meets more of them there, so this stays linear.
FEW = 256
#: Children of a class in a large node, and levels of branching. TREES * DEPTH * BRANCH of the sketch's values name the children.
BRANCH = 2
DEPTH = 4
#: Share of its parent that a child may keep and still branch.
DENSE = 0.5
#: Candidates that a tile offers a class in the first round.
LIMIT = 2
#: Classes held, and classes streaming by, in a tile; WIDE for nodes of more than COMPARED comparisons, so that fewer copies of their rows travel.
BLOCK = 4096
COMPARED = 1 << 30
WIDE = 16_384
#: Sketch values that are looked at first; a pair with fewer than AGREE - (SKETCH - HEAD) among them cannot reach AGREE.
HEAD = 72
#: Pairs of one first class that go to one group.
PAIRS = 512

_SEED = textvec.constants(TREES, 5)
_ODD = textvec.constants(TREES, 6)
_SKETCH_SEED = textvec.constants(SKETCH, 7).astype(np.uint32)
_SKETCH_ODD = textvec.constants(SKETCH, 8).astype(np.uint32) | np.uint32(1)


# ---------------------------------------------------------------- sets


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketches(batches):
    """doc_id, text to doc_id, n, class (digest of the set), minwise tokens, sketch (low 16 bits of each minwise value)."""
    for b in textvec.slices(batches, 1):
        w = textvec.words(b.column(1))
        sets = [textvec.shingles(w.hash[x:y], WIDTH) for x, y in zip(w.bounds[:-1], w.bounds[1:])]
        n = np.array([len(s) for s in sets], np.int32)
        full = np.flatnonzero(n)
        tokens = np.zeros((len(full), TREES), np.uint64)
        sketch = np.zeros((len(full), SKETCH), np.uint16)
        for lo in range(0, len(full), 64):
            part = full[lo : lo + 64]
            joined = np.concatenate([sets[i] for i in part])
            at = np.concatenate(([0], np.cumsum(n[part])[:-1]))
            for t in range(TREES):
                tokens[lo : lo + 64, t] = np.minimum.reduceat((joined ^ _SEED[t]) * _ODD[t], at)
            short = (joined >> np.uint64(32)).astype(np.uint32)
            for t in range(SKETCH):
                sketch[lo : lo + 64, t] = np.minimum.reduceat((short ^ _SKETCH_SEED[t]) * _SKETCH_ODD[t], at) & np.uint32(0xFFFF)
        lists, sketches = [None] * len(sets), [None] * len(sets)
        for i, row, k in zip(full, tokens.view(np.int64), sketch):
            lists[i], sketches[i] = row, k.tobytes()
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n), pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            ["doc_id", "n", "cls", "tokens", "sketch"],
        )


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(-1)


def _sizes_fit(a, b):
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * PERCENT


# ---------------------------------------------------------------- candidate pairs


class _Rows:
    """Columns of an Arrow batch as numpy."""

    def __init__(self, b: pa.RecordBatch, keys: list[str]):
        self.keys = np.stack([b.column(k).to_numpy() for k in keys], 1)
        self.cls = b.column("cls").to_pylist()
        self.comp = b.column("comp").to_numpy()
        self.inside = b.column("inside").to_numpy(zero_copy_only=False)
        self.n = b.column("n").to_numpy().astype(np.int64)
        if "families" in b.schema.names:
            lists = b.column("families")
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            self.families = [values[x:y].tolist() for x, y in zip(offsets[:-1], offsets[1:])]
        sketch = b.column("sketch")
        first = np.frombuffer(sketch.buffers()[1], np.int32)[sketch.offset] if len(sketch) else 0
        self.sketch = np.frombuffer(sketch.buffers()[2], np.uint16, len(sketch) * SKETCH, first).reshape(len(sketch), SKETCH)


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _pair_batch(pairs):
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], schema=_PAIR)


def _leaf_pairs(batches):
    """Rows sorted by node, few a node: all pairs of different components, not both of the family, that may reach the threshold."""
    held: list[tuple] = []
    node = None
    out: list[tuple] = []

    def pairs():
        cls = [h[0] for h in held]
        comp, n = np.array([h[1] for h in held]), np.array([h[2] for h in held])
        i, j = np.triu_indices(len(held), 1)
        inside = np.array([h[4] for h in held])
        fit = (comp[i] != comp[j]) & _sizes_fit(n[i], n[j]) & ~(inside[i] & inside[j])
        i, j = i[fit], j[fit]
        if len(i):
            sketch = np.array([h[3] for h in held])
            fit = _agree(sketch[i], sketch[j]) >= AGREE
            for x, y in zip(i[fit].tolist(), j[fit].tolist()):
                out.append((min(cls[x], cls[y]), max(cls[x], cls[y])))

    for b in batches:
        r = _Rows(b, ["node"])
        for k in range(b.num_rows):
            here = r.keys[k, 0]
            if here != node:
                if len(held) > 1:
                    pairs()
                held, node = [], here
            held.append((r.cls[k], r.comp[k], r.n[k], r.sketch[k], r.inside[k]))
        if len(out) > 5000:
            yield _pair_batch(set(out))
            out = []
    if len(held) > 1:
        pairs()
    if out:
        yield _pair_batch(set(out))


class _Block:
    """Held classes by size, their sketches position by position."""

    def __init__(self, held):
        held = sorted(held, key=lambda h: h[2])
        self.cls = [h[0] for h in held]
        self.comp, self.n = np.array([h[1] for h in held]), np.array([h[2] for h in held])
        self.sketch = np.ascontiguousarray(np.stack([h[3] for h in held]).T)
        self.family: dict[int, list[int]] = {}
        for i, h in enumerate(held):
            for f in h[4] if len(h) > 4 else ():
                self.family.setdefault(f, []).append(i)

    def like(self, comp, n, sketch, most: int | None = None, families=()) -> tuple[list[int], bool]:
        """The held classes of other components and families that may reach the threshold with this one, and whether any is left out:
        with ``most``, the ones that agree on most sketch values."""
        lo = int(np.searchsorted(self.n, -(-n * PERCENT // 100)))
        hi = int(np.searchsorted(self.n, n * 100 // PERCENT, "right"))
        some = (self.sketch[:HEAD, lo:hi] == sketch[:HEAD, None]).sum(0, dtype=np.uint8)
        at = lo + np.flatnonzero((some >= max(0, AGREE - (SKETCH - HEAD))) & (self.comp[lo:hi] != comp))
        if len(at) and (own := [f for f in families if f in self.family]):
            compared = np.zeros(len(self.n), bool)
            for f in own:
                compared[self.family[f]] = True
            at = at[~compared[at]]
        if not len(at):
            return [], False
        agree = (self.sketch[:, at] == sketch[:, None]).sum(0)
        at, agree = at[agree >= AGREE], agree[agree >= AGREE]
        if most is None or len(at) <= most:
            return at.tolist(), False
        return at[np.argsort(-agree, kind="stable")[:most]].tolist(), True


def _block_pairs(most: int):
    """Rows sorted by (node, block, kind): the block's classes (kind 0) are held, the classes they are compared with (kind 1) stream by.
    Each of these gives at most ``most`` pairs, and a row without b if it has more."""

    def run(batches):
        key, held, block = None, [], None
        for b in batches:
            r = _Rows(b, ["node", "block", "kind"])
            out = set()
            for k in range(b.num_rows):
                here = (r.keys[k, 0], r.keys[k, 1])
                if here != key:
                    key, held, block = here, [], None
                if r.keys[k, 2] == 0:
                    held.append((r.cls[k], r.comp[k], r.n[k], r.sketch[k], r.families[k]))
                    continue
                if block is None:
                    if not held:  # no class fell into this block
                        continue
                    block, held = _Block(held), [True]
                found, more = block.like(r.comp[k], r.n[k], r.sketch[k], most, r.families[k])
                out.update((min(block.cls[i], r.cls[k]), max(block.cls[i], r.cls[k])) for i in found)
                if more:
                    out.add((r.cls[k], None))
                if len(out) > 20_000:
                    yield _pair_batch(out)
                    out = set()
            if out:
                yield _pair_batch(out)

    return run


def _node(t, value):
    return F.xxhash64(F.lit(0), t, value)


def shared_nodes(classes: DataFrame) -> DataFrame:
    """(node, t, cls, center): every class in the nodes it shares with others, t the tree, center the node's most popular class."""
    rows = classes.select("cls", F.posexplode("tokens").alias("t", "v")).select(_node(F.col("t"), F.col("v")).alias("node"), "t", "cls")
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(rows.join(sizes, "node"), "nodes")
    return stored(shared.drop("size").join(_centers(shared), "node"), "nodes")


def _centers(rows: DataFrame) -> DataFrame:
    """(node, center) of rows (node, cls, size): the class whose nodes are largest together."""
    popular = rows.groupBy("cls").agg(F.sum("size").alias("fame"))
    return rows.join(popular, "cls").groupBy("node").agg(F.max_by("cls", F.struct("fame", "cls")).alias("center"))


def _star_pairs(classes: DataFrame, shared: DataFrame) -> DataFrame:
    """(a, b): every class with the centers of its nodes."""
    pairs = shared.where("center <> cls").select(F.col("center").alias("a"), F.col("cls").alias("b")).distinct()
    one = classes.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    two = classes.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    same = F.size(F.filter(F.zip_with("t_a", "t_b", lambda x, y: x == y), lambda e: e))
    fits = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * FAMILY) & (same >= FIRST_AGREE)
    return pairs.join(two, "b").join(one, "a").where(fits).select("a", "b")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of nodes that hold more than one component and a class outside the family, with size and outside of their node."""
    nodes = rows.groupBy("node").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"), F.count_if(~F.col("inside")).alias("outside")
    ).where("low <> high and outside > 0")
    return rows.join(nodes.select("node", "size", "outside"), "node")


def _children(rows: DataFrame, sketches: DataFrame, depth: int) -> DataFrame:
    """Every class of these nodes in BRANCH children, named by minwise values that only this tree and depth use."""
    branched = rows.join(sketches, "cls").withColumn("b", F.explode(F.array(*[F.lit(b) for b in range(BRANCH)])))
    place = (F.col("t") * DEPTH + depth) * BRANCH + F.col("b")
    value = F.substr("sketch", (place * 2 + 1).cast("int"), F.lit(2))
    return branched.select(F.xxhash64("node", "b", value).alias("node"), "t", "cls", "comp", "inside", F.col("size").alias("parent"))


def chosen_paths(classes: DataFrame, shared: DataFrame, family: DataFrame) -> DataFrame:
    """(node, t, cls, inside): the classes of all nodes that have to be compared, small ones and closed ones. ``classes``: cls, n, tokens,
    sketch, comp; ``family``: (center, cls)."""
    roots = shared.join(classes.select("cls", "comp"), "cls").join(family.withColumn("inside", F.lit(True)), ["center", "cls"], "left").select(
        "node", "t", "cls", "comp", (F.coalesce("inside", F.lit(False)) | (F.col("center") == F.col("cls"))).alias("inside"),
        F.lit(1 << 62).alias("parent"),
    )
    level, ends = stored(_mixed(roots), "paths"), []
    for depth in range(DEPTH):
        branches = (F.col("size") > LEAF) & (F.col("outside") > FEW) & (F.col("size") <= F.col("parent") * DENSE)
        ends.append(level.where(~branches))
        large = level.where(branches)
        if large.isEmpty():
            break
        level = stored(_mixed(_children(large, classes.select("cls", "sketch"), depth)), "paths")
    else:
        ends.append(level)
    return reduce(DataFrame.unionByName, ends).select("node", "t", "cls", "inside", "size")


def _small_pairs(paths: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): pairs of different components in nodes of at most LEAF classes."""
    leaf = paths.where(F.col("size") <= LEAF).join(classes, "cls").repartition("node").sortWithinPartitions("node")
    return leaf.select("node", "cls", "comp", "inside", "n", "sketch").mapInArrow(_leaf_pairs, "a binary, b binary")


def _closed_pairs(paths: DataFrame, classes: DataFrame, most: int, again: DataFrame | None = None) -> DataFrame:
    """(a, b): pairs of different components in larger nodes, at most ``most`` a class and tile; b null for classes that have more. With
    ``again`` (cls), for these classes only."""
    rows = paths.where(F.col("size") > LEAF).drop("size").join(classes.select("cls", "comp"), "cls")
    rows = stored(_mixed(rows).drop("comp"), "closed")
    tile = F.when(F.col("size") * F.col("outside") > COMPARED, WIDE).otherwise(BLOCK)
    # Tile (p, q) of a node holds the outside classes of part p; all classes of part q stream by.
    told = rows.withColumns({"blocks": F.ceil(F.col("outside") / tile).cast("long"), "lots": F.ceil(F.col("size") / tile).cast("long")})

    def part(of: str):
        return F.pmod(F.xxhash64("cls"), of)

    def each(of: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    own = told.where(~F.col("inside")).withColumns({"p": part("blocks"), "q": each("lots"), "kind": F.lit(0).cast("long")})
    every = told if again is None else told.join(again, "cls", "left_semi")
    every = every.withColumns({"p": each("blocks"), "q": part("lots"), "kind": F.lit(1).cast("long")})
    sent = own.unionByName(every).withColumn("block", F.col("p") * F.col("lots") + F.col("q")).select("node", "block", "kind", "cls", "inside")
    sent = sent.join(classes, "cls").repartition("node", "block").sortWithinPartitions("node", "block", "kind")
    return sent.select("node", "block", "kind", "cls", "comp", "inside", "n", "sketch", "families").mapInArrow(_block_pairs(most), "a binary, b binary")


def _further_pairs(paths: DataFrame, classes: DataFrame, more: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): every class with new centers of its larger nodes, of which ``more`` (cls) may become one that are none in ``members``."""
    closed = paths.where(F.col("size") > LEAF).select("node", "cls")
    fresh = more.join(members.select(F.col("center").alias("cls")), "cls", "left_anti")
    rows = closed.join(fresh, "cls", "left_semi")
    rows = stored(rows.join(rows.groupBy("node").agg(F.count("*").alias("size")), "node"), "further")
    return _star_pairs(classes, closed.join(_centers(rows), "node"))


def tree_links(texts: DataFrame, classes: DataFrame, named: DataFrame, shared: DataFrame, members: DataFrame) -> DataFrame:
    """``named`` (cls, comp) after the links out of all trees. ``members``: (center, cls) of the families that have been compared."""

    def told():
        return classes.select("cls", "n", "sketch").join(named, "cls")

    def with_families():
        own = members.unionByName(members.select("center", F.col("center").alias("cls")))
        own = own.groupBy("cls").agg(F.collect_set(F.xxhash64("center")).alias("families"))
        return told().join(own, "cls", "left").withColumn("families", F.coalesce("families", F.array().cast("array<long>")))

    paths = chosen_paths(told(), shared, members)
    found = stored(_small_pairs(paths, told()).unionByName(_closed_pairs(paths, with_families(), LIMIT)).distinct(), "candidates")
    most = LIMIT
    while True:
        named = join_components(named, _compare(texts, classes, found.where("b is not null"), False).select("a", "b"))
        more = found.where("b is null").select(F.col("a").alias("cls"))
        if not (left := more.count()):
            return named
        if left > FEW:  # fewer meet at most FEW times as many classes, which stays linear
            named, further = star_links(texts, classes, named, _further_pairs(paths, classes, more, members))
            members = stored(members.unionByName(further).distinct(), "members")
        most *= 8
        found = stored(_closed_pairs(paths, with_families(), most, more).distinct(), "candidates")


# ---------------------------------------------------------------- families


def _family_links(batches):
    """Rows sorted by (center, block, kind): members outside the center's component (kind 0) are held, all members (kind 1) stream by.

    missing: bits of the center's set that a member lacks; extra: its shingles beside the center's."""
    key = None
    held: list[dict] = []
    lack = None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if (r["center"], r["block"]) != key:
                key, held, lack = (r["center"], r["block"]), [], None
            if r["kind"] == 0:
                held.append(r)
                continue
            if not held:  # no member fell into this block
                continue
            if lack is None:
                wide = -(-len(r["missing"]) // 8) * 8
                lack = np.stack([np.frombuffer(h["missing"].ljust(wide, b"\0"), np.uint64) for h in held])
                n, n_lack = np.array([h["n"] for h in held]), np.bitwise_count(lack).sum(1).astype(np.int64)
                beside: dict[int, list[int]] = {}
                for i, h in enumerate(held):
                    for x in np.frombuffer(h["extra"], np.uint64).tolist():
                        beside.setdefault(x, []).append(i)
                up: dict[int, int] = {}  # components that links found here have joined
            own = np.frombuffer(r["missing"].ljust(wide, b"\0"), np.uint64)
            both = r["n_center"] - n_lack - int(np.bitwise_count(own).sum()) + np.bitwise_count(lack & own).sum(1).astype(np.int64)
            for x in np.frombuffer(r["extra"], np.uint64).tolist():
                if x in beside:
                    both[beside[x]] += 1
            for i in np.flatnonzero(100 * both >= PERCENT * (n + r["n"] - both)).tolist():
                a, b = _root(up, held[i]["comp"]), _root(up, r["comp"])
                if a != b:
                    up[max(a, b)] = min(a, b)
                    out.append((held[i]["cls"], r["cls"]))
        if out:
            yield _pair_batch(out)


def _root(up: dict, x):
    while x in up:
        x = up[x]
    return x


def family_links(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(a, b): links between members of one family that join components. ``members``: center, cls, n_center, n, missing, extra; ``comps``:
    cls, comp."""
    named = members.join(comps, "cls").join(comps.select(F.col("cls").alias("center"), F.col("comp").alias("main")), "center")
    named = stored(named, "families")
    blocks = named.where("comp <> main").groupBy("center").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    told = named.join(blocks, "center")
    own = told.where("comp <> main").withColumns({"block": F.pmod(F.xxhash64("cls"), "blocks"), "kind": F.lit(0)})
    every = told.withColumns({"block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)), "kind": F.lit(1)})
    sent = own.unionByName(every).drop("main", "blocks").repartition("center", "block").sortWithinPartitions("center", "block", "kind")
    return sent.mapInArrow(_family_links, "a binary, b binary")


def star_links(texts: DataFrame, classes: DataFrame, named: DataFrame, pairs: DataFrame, links: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``named`` (cls, comp) after the links (and ``links``, if any) of pairs (center, class) and those in the families that they make, and these
    families' (center, cls)."""
    tried = stored(_compare(texts, classes, pairs, True), "tried")
    linked = tried.where("linked").select("a", "b")
    named = join_components(named, linked if links is None else links.unionByName(linked))
    members = tried.where("missing is not null").select(
        F.col("a").alias("center"), F.col("b").alias("cls"), F.col("n_a").alias("n_center"), F.col("n_b").alias("n"), "missing", "extra"
    )
    named = join_components(named, family_links(members, named))
    return named, members.select("center", "cls").distinct()


# ---------------------------------------------------------------- confirming pairs on full sets


def _wanted_sets(bits):
    def run(batches):
        keep = np.frombuffer(bits.value, np.uint8)
        for b in textvec.slices(batches, 1):
            ids = np.asarray(b.column(0).fill_null(0)).view(np.uint64)
            mask = bloom_mask(keep, textvec.mix(ids))
            if not mask.any():
                continue
            w = textvec.words(b.column(1).filter(pa.array(mask)))
            sets = [s for x, y in zip(w.bounds[:-1], w.bounds[1:]) if len(s := textvec.shingles(w.hash[x:y], WIDTH))]
            for lo in range(0, len(sets), 1000):
                part = sets[lo : lo + 1000]
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in part], pa.binary()), pa.array([s.tobytes() for s in part], pa.binary())], ["cls", "items"])

    return run


_CONFIRMED = "a binary, b binary, linked boolean, n_a int, n_b int, missing binary, extra binary"


def _confirm(differences: bool):
    """Rows sorted by (a, salt, kind): the set of a first, then those it is compared with. Pairs that are linked, and with ``differences``
    those at least FAMILY percent similar, with what b lacks of a (bits) and has beside a."""

    def run(batches):
        a = first = None
        for b in batches:
            out = []
            for k, kind, cls, items in zip(b.column("a").to_pylist(), b.column("kind").to_pylist(), b.column("cls").to_pylist(), b.column("items")):
                s = np.frombuffer(items.as_buffer(), np.uint64)
                if kind == 0:
                    a, first = k, s
                    continue
                if k != a:
                    raise ValueError("a pair's first set is missing")
                at = np.minimum(np.searchsorted(first, s), len(first) - 1)
                same = first[at] == s
                both = int(same.sum())
                union = len(first) + len(s) - both
                linked = 100 * both >= PERCENT * union
                if differences and 100 * both >= FAMILY * union:
                    has = np.zeros(len(first), bool)
                    has[at[same]] = True
                    out.append((a, cls, linked, len(first), len(s), np.packbits(~has).tobytes(), s[~same].tobytes()))
                elif linked:
                    out.append((a, cls, True, len(first), len(s), None, None))
            if out:
                cols = zip(*out)
                kinds = (pa.binary(), pa.binary(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["a", "b", "linked", "n_a", "n_b", "missing", "extra"])

    return run


def _compare(docs: DataFrame, classes: DataFrame, pairs: DataFrame, differences: bool) -> DataFrame:
    """The pairs (a, b) that reach the threshold, or with ``differences`` FAMILY percent (_CONFIRMED)."""
    spark = docs.sparkSession
    pairs = stored(pairs, "pairs")
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("salts"))
    salted = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), "b")
    others = salted.select("a", "salt", F.lit(1).alias("kind"), F.col("b").alias("cls"))
    firsts = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("a").alias("cls"))
    used = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    labels = classes.join(used, "cls", "left_semi").select("label")
    bits = spark.sparkContext.broadcast(bloom(labels.mapInArrow(_mix_labels, "k long"), F.col("k")))
    sets = docs.mapInArrow(_wanted_sets(bits), "cls binary, items binary")
    sent = firsts.unionByName(others).join(sets, "cls").repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    return sent.select("a", "kind", "cls", "items").mapInArrow(_confirm(differences), _CONFIRMED)


def _mix_labels(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(textvec.mix(np.asarray(b.column(0)).view(np.uint64)).view(np.int64))], ["k"])


# ---------------------------------------------------------------- components


def components(links: DataFrame) -> DataFrame:
    """(label, comp) of the labels in ``links`` (x, y): the smallest label reachable.

    Each round takes the smallest label among neighbours, then the smallest of all labels that had the same one: groups of
    labels merge with their neighbours, so the number of rounds grows with the logarithm of a chain's length."""
    both = stored(links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    if both.isEmpty():
        return both.toDF("label", "comp")
    state = stored(both.select(F.col("x").alias("label")).distinct().withColumn("comp", F.col("label")), "components")
    while True:
        near = both.join(state.select(F.col("label").alias("y"), "comp"), "y").groupBy(F.col("x").alias("label")).agg(F.min("comp").alias("near"))
        step = stored(state.join(near, "label").select("label", F.col("comp").alias("old"), F.least("comp", "near").alias("new")), "components")
        if step.where("old <> new").isEmpty():
            return state
        jump = step.groupBy("old").agg(F.min("new").alias("comp"))
        state = stored(step.join(jump, "old").select("label", "comp"), "components")


def join_components(named: DataFrame, links: DataFrame) -> DataFrame:
    """``named`` (cls, comp) after links (a, b) between classes; only links between different components are looked at."""
    one = named.select(F.col("cls").alias("a"), F.col("comp").alias("x"))
    two = named.select(F.col("cls").alias("b"), F.col("comp").alias("y"))
    moved = components(links.join(one, "a").join(two, "b").where("x <> y").select("x", "y").distinct())
    if moved.isEmpty():
        return named
    moved = moved.select(F.col("label").alias("comp"), F.col("comp").alias("now"))
    return stored(named.join(moved, "comp", "left").select("cls", F.coalesce("now", "comp").alias("comp")), "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(texts.mapInArrow(_sketches, "doc_id long, n int, cls binary, tokens array<long>, sketch binary"), "sketches")
    linked = rows.where(F.col("cls").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(
        linked.groupBy("cls").agg(F.min("doc_id").alias("label"), *[F.first(c).alias(c) for c in ("n", "tokens", "sketch")]), "classes"
    )
    # Rows that share a doc_id are one node, whatever their texts.
    twice = linked.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a <> z").select("doc_id", "a")
    same_id = linked.join(twice, "doc_id").where("cls <> a").select("a", F.col("cls").alias("b")).distinct()
    shared = shared_nodes(classes)
    named, members = star_links(texts, classes, classes.select("cls", F.col("label").alias("comp")), _star_pairs(classes, shared), same_id)
    named = tree_links(texts, classes, named, shared, members).withColumnRenamed("comp", "component")
    out = rows.join(named, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows whose doc_id is its component's smallest; columns as they were."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
