"""Rewriting stored Spark ML trees: pruning one tree, putting two boosted ensembles together.

A saved model is a metadata text and tables of nodes (a row for each node, ids in pre-order) and, for ensembles, of trees with their weights. Both
functions read those, write a new model beside and load it: what they handle is of the size of a model, never of the data.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from batchlens.session import ensure_checkpoint_dir


def folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"


def _saved(model) -> str:
    path = folder(SparkSession.active())
    model.write().save(path)
    return path


def metadata_of(stage) -> dict:
    """The metadata text that Spark ML stores for an estimator or a model."""
    return json.loads(SparkSession.active().read.text(f"{_saved(stage)}/metadata").first()["value"])


def _write_metadata(spark: SparkSession, source: str, target: str, **changes) -> None:
    meta = json.loads(spark.read.text(f"{source}/metadata").first()["value"]) | changes
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{target}/metadata")


def pruned_nodes(nodes: list[dict], max_depth: int, min_split: int) -> list[dict]:
    """The tree's nodes with every split undone that is at a node of fewer than ``min_split`` rows or at ``max_depth``, numbered in pre-order again."""
    by_id = {n["id"]: n for n in nodes}
    out: list[dict] = []

    def keep(n: dict, depth: int) -> int:
        at = len(out)
        out.append(dict(n, id=at))
        if n["leftChild"] < 0:
            return at
        if depth >= max_depth or n["rawCount"] < min_split:
            out[at].update(leftChild=-1, rightChild=-1, gain=-1.0, split=(-1, [], -1))  # as Spark writes a leaf
            return at
        left = keep(by_id[n["leftChild"]], depth + 1)
        right = keep(by_id[n["rightChild"]], depth + 1)
        out[at].update(leftChild=left, rightChild=right)
        return at

    keep(by_id[0], 0)
    return out


def pruned(model: DecisionTreeRegressionModel, max_depth: int, min_split: int) -> DecisionTreeRegressionModel:
    """The tree that would have been grown with this depth and least number of rows of a split node.

    Growing is top-down and greedy: a node's split depends on its own rows only. So the smaller tree is the larger one without the splits that it
    may not have."""
    spark = SparkSession.active()
    source, target = _saved(model), folder(spark)
    table = spark.read.parquet(f"{source}/data")
    nodes = pruned_nodes([r.asDict() for r in table.collect()], max_depth, min_split)
    rows = [tuple(n[f] for f in table.columns) for n in nodes]
    spark.createDataFrame(rows, table.schema).coalesce(1).write.parquet(f"{target}/data")
    _write_metadata(spark, source, target)
    return DecisionTreeRegressionModel.load(target)


def merged(first: GBTRegressionModel, second: GBTRegressionModel) -> GBTRegressionModel:
    """One ensemble whose prediction is the sum of both: their trees and weights one after the other."""
    spark = SparkSession.active()
    one, two, target = _saved(first), _saved(second), folder(spark)
    n, m = first.getNumTrees, second.getNumTrees
    for name, key in (("data", "treeID"), ("treesMetadata", None)):
        a, b = (spark.read.parquet(f"{p}/{name}") for p in (one, two))
        key = key or a.columns[0]
        a.unionByName(b.withColumn(key, (F.col(key) + n).cast(a.schema[key].dataType))).write.parquet(f"{target}/{name}")
    _write_metadata(spark, one, target, numTrees=n + m)
    return GBTRegressionModel.load(target)
