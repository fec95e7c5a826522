"""Gradient-boosted regression trees by histograms (L3, L4, L7): the trees that Spark ML's ``GBTRegressor`` grows, in a tenth of its time a row.

Spark ML walks every row through objects and adds up a cell for each of its features. Here the rows are binned once, into blocks of BLOCK rows of one byte a
feature, stored in the shared folder. A level of a tree is one job: tasks pass over the blocks, find each row's node with whole-column comparisons, and add up
count, sum and sum of squares of the residuals for every node, feature and bin; a few features share one table, whose margins are theirs. The driver adds up
the tasks' tables, which depend on nodes and bins only, and picks the splits.

Candidates, gains, ties and leaves are Spark's: at most ``maxBins`` bins a feature (from all rows, or from a sample of max(10,000, maxBins^2) rows of a larger
table), categories ordered by their mean in a node, variance as impurity, the first best split in feature order, the first tree with weight 1 and the
others with the step size. Trees come back as a ``GBTRegressionModel``.

Blocks with their residuals are kept in memory and on the workers' disks (MEMORY_AND_DISK) from tree to tree. Every REBASE trees they are computed from the stored blocks
again, so what is lost with a worker is found with at most that many steps.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.base import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.models.treefiles import folder, metadata_of
from batchlens.session import kept_table

BLOCK = 65_536
#: Rows that one task trains on by itself; between the workers a level takes longer than its sums.
ALONE = 4 * BLOCK
REBASE = 20
#: Most cells that features share in a table of a node.
CELLS = 1024
#: Values of a sample that the driver holds at once, where there is more than one feature.
HELD = 2_000_000
_EPSILON = 2.0**-52
_NODES = """treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double,
  leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"""


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most about ``most`` thresholds between the values of a feature, as Spark ML chooses them: all midpoints if they are no more, else one where a
    value's count passes a multiple of an even share."""
    vals, counts = np.unique(values, return_counts=True)
    if len(vals) - 1 <= most:
        cuts = (vals[:-1] + vals[1:]) / 2.0
    else:
        stride = len(values) / (most + 1)
        chosen, current, target = [], float(counts[0]), stride
        for i in range(1, len(vals)):
            before = current
            current += float(counts[i])
            if abs(before - target) < abs(current - target):
                chosen.append((vals[i - 1] + vals[i]) / 2.0)
                target += stride
        cuts = np.array(chosen)
    return cuts[~np.isnan(cuts)]


def packed(sizes: dict[int, int], most: int) -> list[list[int]]:
    """Features put together, first fit of the largest, so that a group has at most this many cells (or is one feature)."""
    groups: list[tuple[int, list[int]]] = []
    for f in sorted(sizes, key=lambda f: -sizes[f]):
        at = next((k for k, (cells, _) in enumerate(groups) if cells * sizes[f] <= most), None)
        if at is None:
            groups.append((sizes[f], [f]))
        else:
            groups[at] = (groups[at][0] * sizes[f], [*groups[at][1], f])
    return [g for _, g in groups]


class Binning:
    """How feature values become bins: thresholds of the continuous features, numbers of values of the categories."""

    def __init__(self, count: int, cuts: dict[int, np.ndarray], arity: dict[int, int], cells: int):
        self.count, self.cuts, self.arity, self.started = count, cuts, arity, False
        bins = [arity[f] if f in arity else len(cuts[f]) + 1 for f in range(count)]
        self.sizes = {f: n for f, n in enumerate(bins) if n > 1}  # a feature with one bin has no split
        self.groups = packed(self.sizes, cells)
        most = max([*bins, 1])
        self.dtype = np.dtype(np.uint8 if most <= 256 else np.uint16 if most <= 65536 else np.uint32)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bins of a matrix of rows, a line for each feature."""
        out = np.empty((self.count, len(x)), self.dtype)
        for f in range(self.count):
            if f in self.arity:
                v = x[:, f]
                if not ((v >= 0) & (v < self.arity[f]) & (v == np.floor(v))).all():
                    raise ValueError(f"feature {f} has a value that is not one of its {self.arity[f]} categories")
                out[f] = v
            else:
                out[f] = np.searchsorted(self.cuts[f], x[:, f], side="left")
        return out


def fit_binning(rows: DataFrame, count: int, n: int, arity: dict[int, int], max_bins: int, seed: int) -> Binning:
    """Thresholds from all of ``rows`` (x array, y), or from a sample of the size that Spark ML takes."""
    bins = min(max_bins, n)
    if any(v > bins for v in arity.values()):
        raise ValueError(f"a category has {max(arity.values())} values, more than the {bins} bins that {n} rows and maxBins {max_bins} allow")
    arity = {f: v for f, v in arity.items() if v > 1}
    wide, wanted = [f for f in range(count) if f not in arity], max(bins * bins, 10_000)
    some, cuts = rows if n <= wanted else rows.sample(wanted / n, seed), {}
    step = max(1, HELD // wanted)
    for at in range(0, len(wide), step):
        part = wide[at : at + step]
        table = some.select(*[F.col("x")[f].alias(f"x{f}") for f in part]).toArrow()
        for f in part:
            cuts[f] = thresholds(table.column(f"x{f}").to_numpy().astype(np.float64), bins - 1)
    return Binning(count, cuts, arity, CELLS if n > BLOCK else 1)  # a block's sums by feature are Spark's to the bit, and so are its ties


def blocks(rows: DataFrame, binning: Binning) -> DataFrame:
    """The rows as stored blocks: bins and labels of up to BLOCK rows as bytes, dealt evenly over as many files as there are cores."""

    def cut(batches):
        held, size = [], 0

        def block():
            codes, y = (np.concatenate([h[i] for h in held], axis=-1) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["codes", "y"])

        for b in batches:
            y = b.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isnan(y).any():
                raise ValueError("labels must be neither null nor NaN")
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(y), binning.count)
            for lo in range(0, len(y), BLOCK):
                held.append((binning.codes(x[lo : lo + BLOCK]), y[lo : lo + BLOCK]))
                size += len(held[-1][1])
                if size >= BLOCK:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    made = kept_table(rows.mapInArrow(cut, "codes binary, y binary"), "boost-cut")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return kept_table(made.repartition(max(1, min(made.count(), cores))), "boost-blocks")


def walk(codes: np.ndarray, splits: list[list[tuple]]) -> np.ndarray:
    """The node of every row after these levels of splits (node, feature, bin or table of the bins that go right). The root is 1, node k has 2k and 2k + 1."""
    small = np.uint8 if len(splits) < 8 else np.uint16 if len(splits) < 16 else np.uint32
    at = np.ones(codes.shape[1], small)
    for level in splits:
        for node, f, rule in level:
            right = (rule.take(codes[f]) if isinstance(rule, np.ndarray) else codes[f] > rule).astype(small)
            right += small(node)
            right *= at == node
            at += right  # node + (node or node + 1) is the child
    return at


def histograms(codes: np.ndarray, r: np.ndarray, at: np.ndarray, slots: np.ndarray, binning: Binning, into: dict) -> None:
    """Adds count, sum and sum of squares of ``r`` by slot and cell of each group of features. Slot 0 holds the rows of finished nodes."""
    squares, many = r * r, int(slots.max()) + 1
    for g, features in enumerate(binning.groups):
        cells = int(np.prod([binning.sizes[f] for f in features]))
        key = (slots * cells).take(at)
        for k, f in enumerate(features):
            stride = int(np.prod([binning.sizes[o] for o in features[k + 1 :]], dtype=np.int64))
            key += codes[f] if stride == 1 else np.multiply(codes[f], stride, dtype=np.int64)
        table = into.setdefault(g, np.zeros((3, many * cells)))
        for k, w in enumerate((None, r, squares)):
            table[k] += np.bincount(key, w, minlength=many * cells)


def margins(tables: dict, many: int, binning: Binning) -> dict[int, np.ndarray]:
    """(3, slots but the first, bins) of every feature out of the groups' tables."""
    out = {}
    for g, features in enumerate(binning.groups):
        cube = tables[g].reshape(3, many, *[binning.sizes[f] for f in features])[:, 1:]
        for k, f in enumerate(features):
            out[f] = cube.sum(axis=tuple(2 + i for i in range(len(features)) if i != k))
    return out


def _variance(s: np.ndarray) -> np.ndarray:
    n = np.where(s[0] == 0, 1.0, s[0])
    return np.where(s[0] == 0, 0.0, (s[2] - s[1] * s[1] / n) / n)


def best_split(hists: dict[int, np.ndarray], slot: int, stats: np.ndarray, binning: Binning):
    """(gain, feature, split number, order of the bins, left stats, right stats) of the first best split of a node, None without a valid one."""
    best, impurity = None, _variance(stats)
    for f in sorted(hists):
        h = hists[f][:, slot]
        order = np.arange(h.shape[1])
        if f in binning.arity:
            means = np.where(h[0] > 0, h[1] / np.where(h[0] > 0, h[0], 1.0), np.inf)
            order = np.argsort(means, kind="stable")
        sums = np.cumsum(h[:, order], axis=1)
        left, right = sums[:, :-1], sums[:, -1:] - sums[:, :-1]
        share = left[0] / sums[0, -1]
        gain = impurity - share * _variance(left) - (right[0] / sums[0, -1]) * _variance(right)
        gain = np.where((left[0] < 1) | (right[0] < 1) | ~(gain >= 0), -np.inf, gain)
        k = int(np.argmax(gain))
        if gain[k] > -np.inf and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), f, k, order, left[:, k], right[:, k])
    return best


class Tree:
    """A tree while it grows: nodes by number, splits by level as ``walk`` reads them."""

    def __init__(self, depth: int):
        self.depth, self.nodes, self.splits, self.open = depth, {}, [], [1]

    def slots(self) -> np.ndarray:
        out = np.zeros(2 ** (len(self.splits) + 1), np.int64)
        out[self.open] = np.arange(1, len(self.open) + 1)
        return out

    def grow(self, hists: dict[int, np.ndarray], total: np.ndarray, binning: Binning) -> None:
        """The splits of the open nodes; ``total`` are the root's stats."""
        level, going = [], []
        if not self.splits and hists:  # as Spark has them: both sides of the first split
            sums = np.cumsum(hists[min(hists)][:, 0], axis=1)
            if min(hists) not in binning.arity:
                total = sums[:, 0] + (sums[:, -1] - sums[:, 0])
        for slot, node in enumerate(self.open):
            own = self.nodes.setdefault(node, {"stats": total, "impurity": float(_variance(total))})
            found = best_split(hists, slot, own["stats"], binning)
            if found is None:
                own["impurity"] = -1.0  # as Spark writes a node without a valid split
            if found is None or found[0] <= 0 or len(self.splits) == self.depth:
                continue
            gain, f, k, order, left, right = found
            if f in binning.arity:
                rule = np.ones(binning.arity[f], np.uint8)
                rule[order[: k + 1]] = 0
                own |= {"gain": gain, "split": (f, sorted(float(c) for c in order[: k + 1]), binning.arity[f])}
            else:
                rule = k
                own |= {"gain": gain, "split": (f, [float(binning.cuts[f][k])], -1)}
            level.append((node, f, rule))
            for child, stats in ((2 * node, left), (2 * node + 1, right)):
                self.nodes[child] = {"stats": stats, "impurity": float(_variance(stats))}
                if len(self.splits) + 1 < self.depth and abs(self.nodes[child]["impurity"]) >= _EPSILON:
                    going.append(child)
        self.splits.append(level)
        self.open = going

    def leaves(self) -> np.ndarray:
        """The prediction of every node by its number (0 for numbers that there are not)."""
        out = np.zeros(2 ** (len(self.splits) + 1))
        for node, own in self.nodes.items():
            out[node] = self._mean(own)
        return out

    @staticmethod
    def _mean(own: dict) -> float:
        n, s, _ = own["stats"]
        return float(s / n) if n else 0.0

    def rows(self) -> list[tuple]:
        """The nodes as Spark ML stores them, in pre-order; two leaves with one prediction become one."""

        def cut(node: int) -> tuple:
            own = self.nodes[node]
            if "split" in own:
                left, right = cut(2 * node), cut(2 * node + 1)
                if left[1] or right[1] or self._mean(left[0]) != self._mean(right[0]):
                    return own, (left, right)
            return own, None

        out: list = []

        def put(own: dict, children) -> int:
            at = len(out)
            out.append(None)
            ids = [put(*c) for c in children] if children else [-1, -1]
            n = own["stats"]
            out[at] = (at, self._mean(own), own["impurity"], [float(v) for v in n], int(n[0]), own["gain"] if children else -1.0, *ids, own["split"] if children else (-1, [], -1))
            return at

        put(*cut(1))
        return out


class Held:
    """The blocks of a small table in the memory of one task: (bins, labels, predictions so far)."""

    def __init__(self, rows: list[tuple], binning: Binning):
        self.rows, self.binning = [renewed(codes, y, [], binning) for codes, y in rows], binning

    def advance(self, done: list[tuple]) -> None:
        self.rows = [stepped(*row, *done[-1]) if done else row for row in self.rows]

    def count(self, splits: list, slots: np.ndarray) -> list[tuple]:
        return [counted(self.rows, splits, slots, self.binning)]


class Spread:
    """The blocks of a table, with the predictions so far, over the workers."""

    def __init__(self, base, binning: Binning):
        self.base, self.binning, self.state, self.old = base, binning, None, None

    def advance(self, done: list[tuple]) -> None:
        binning = self.binning
        if len(done) % REBASE == 0:
            trees = list(done)
            new = self.base.mapPartitions(lambda part: (renewed(codes, y, trees, binning) for codes, y in part))
        else:
            last = done[-1]
            new = self.state.mapPartitions(lambda part: (stepped(*row, *last) for row in part))
        self.close(self.old)
        self.old, self.state = self.state, new.persist(StorageLevel.MEMORY_AND_DISK)

    def count(self, splits: list, slots: np.ndarray) -> list[tuple]:
        binning = self.binning
        got = self.state.mapPartitions(lambda part: [counted(part, splits, slots, binning)]).collect()
        self.old = self.close(self.old)  # the new state is there
        return got

    @staticmethod
    def close(*held) -> None:
        for one in held:
            if one is not None:
                one.unpersist()


def renewed(codes: bytes, y: bytes, trees: list[tuple], binning: Binning) -> tuple:
    codes, y = np.frombuffer(codes, binning.dtype).reshape(binning.count, -1), np.frombuffer(y, np.float64)
    row = codes, y, np.zeros(len(y))
    for tree in trees:
        row = stepped(*row, *tree)
    return row


def stepped(codes: np.ndarray, y: np.ndarray, at: np.ndarray, splits: list, change: np.ndarray) -> tuple:
    """A block with a tree's part in its predictions."""
    return codes, y, at + change.take(walk(codes, splits))


def counted(part, splits: list, slots: np.ndarray, binning: Binning) -> tuple[np.ndarray, dict]:
    """Count, sum and sum of squares of the residuals (the loss's negative gradient; of the labels themselves for the first tree) of some blocks: in all, and by
    feature, open node and bin."""
    tables: dict = {}
    total = np.zeros(3)
    for codes, y, at in part:
        r = 2.0 * (y - at) if binning.started else y
        if not splits:
            total += (len(r), r.sum(), (r * r).sum())
        if binning.groups:
            histograms(codes, r, walk(codes, splits), slots, binning, tables)
    return total, margins(tables, int(slots.max()) + 1, binning) if tables else {}


def grown(source, binning: Binning, iterations: int, depth: int, step: float) -> list[tuple[float, list[tuple]]]:
    """(weight, stored nodes) of every tree."""
    done: list[tuple] = []
    out = []
    for m in range(iterations):
        source.advance(done)
        binning.started = m > 0
        tree = Tree(depth)
        while tree.open and len(tree.splits) < max(depth, 1):
            got = source.count(tree.splits, tree.slots())
            parts = [h for _, h in got if h]
            tree.grow({f: np.sum([h[f] for h in parts], axis=0) for f in binning.sizes}, np.sum([t for t, _ in got], axis=0), binning)
        weight = step if m else 1.0
        done.append((tree.splits, tree.leaves() * weight))
        out.append((weight, tree.rows()))
    return out


def boosted(rows: DataFrame, count: int, arity: dict[int, int], gbt: GBTRegressor) -> list[tuple[float, list[tuple]]]:
    """(weight, stored nodes) of every tree. ``rows``: x array of ``count`` doubles, y."""
    n = rows.count()
    if not n:
        raise ValueError("boosting takes one or more rows")
    binning = fit_binning(rows, count, n, arity, gbt.getMaxBins(), gbt.getSeed())
    how = (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize())
    if n <= ALONE:
        base = blocks(rows.coalesce(1), binning).coalesce(1).rdd
        return base.mapPartitions(lambda part: grown(Held(list(part), binning), binning, *how)).collect()
    source = Spread(blocks(rows, binning).rdd, binning)
    try:
        return grown(source, binning, *how)
    finally:
        source.close(source.state, source.old)


def as_model(trees: list[tuple[float, list[tuple]]], count: int, gbt: GBTRegressor) -> GBTRegressionModel:
    """The trees as Spark ML's own model, by way of its stored form."""
    spark, target = SparkSession.active(), folder(SparkSession.active())
    own = {k: gbt.getOrDefault(k) for k in ("featuresCol", "labelCol", "maxBins", "maxDepth", "seed")}
    tree = json.dumps(metadata_of(DecisionTreeRegressor(**own)) | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel"})
    nodes = [(k, row) for k, (_, rows) in enumerate(trees) for row in rows]
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.parquet(f"{target}/data")
    spark.createDataFrame([(k, tree, w) for k, (w, _) in enumerate(trees)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{target}/treesMetadata")
    meta = metadata_of(gbt) | {"class": "org.apache.spark.ml.regression.GBTRegressionModel", "numFeatures": count, "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{target}/metadata")
    return GBTRegressionModel.load(target)


class BoostedTrees(Estimator):
    """A pipeline stage that fits what the ``GBTRegressor`` it holds describes."""

    def __init__(self, gbt: GBTRegressor):
        super().__init__()
        self.gbt = gbt

    def _fit(self, df: DataFrame) -> GBTRegressionModel:
        gbt = self.gbt
        attrs = df.schema[gbt.getFeaturesCol()].metadata["ml_attr"]
        arity = {a["idx"]: len(a["vals"]) for a in attrs.get("attrs", {}).get("nominal", [])}
        rows = df.select(vector_to_array(gbt.getFeaturesCol()).alias("x"), F.col(gbt.getLabelCol()).cast("double").alias("y"))
        return as_model(boosted(rows, attrs["num_attrs"], arity, gbt), attrs["num_attrs"], gbt)
