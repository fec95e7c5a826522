"""The trees of ``models.boosting`` are those of Spark ML's GBTRegressor, whether one task or many train them."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from batchlens.models import boosting
from batchlens.models.boosting import Binning, BoostedTrees, thresholds, walk
from batchlens.models.trees import BoostModel
from batchlens.spec import TRIPS_EV


def _table(spark, n=3000, files=1):
    rng = np.random.default_rng(7)
    a, b, c, w = rng.normal(size=n), rng.integers(0, 9, n), rng.integers(0, 6, n), np.full(n, 2.5)
    y = np.where(a > 0.3, 5.0, -1.0) * (c % 3) + b * 0.7 + rng.normal(size=n) * 0.2
    rows = [(float(p), float(q), "none" if k == 5 else f"c{k}", float(v), float(t)) for p, q, k, v, t in zip(a, b, c, w, y)]
    d = spark.createDataFrame(rows, "a double, b double, c string, w double, y double").repartition(files)
    d = StringIndexer(inputCol="c", outputCol="ci", handleInvalid="keep", stringOrderType="alphabetAsc").fit(d).transform(d)
    return VectorAssembler(inputCols=["a", "ci", "b", "w"], outputCol="f").transform(d)


def _gbt(**kw):
    return GBTRegressor(**{"featuresCol": "f", "labelCol": "y", "maxIter": 5, "maxDepth": 4, "stepSize": 0.3, "seed": 42, **kw})


def _predicted(model, d):
    return np.array([r[0] for r in model.transform(d).orderBy("a", "b", "c", "y").select("prediction").collect()])


@pytest.fixture(scope="module")
def table(spark):
    return _table(spark)


def test_trees_are_those_of_spark(table):
    mine, theirs = BoostedTrees(_gbt()).fit(table), _gbt().fit(table)
    assert isinstance(mine, GBTRegressionModel) and mine.treeWeights == theirs.treeWeights and mine.numFeatures == 4
    assert mine.toDebugString.split("\n")[1:] == theirs.toDebugString.split("\n")[1:]
    assert np.array_equal(_predicted(mine, table), _predicted(theirs, table))
    assert mine.evaluateEachIteration(table, "squared") == pytest.approx(theirs.evaluateEachIteration(table, "squared"), rel=1e-12)


def test_many_tasks_grow_the_trees_of_one(spark, table, monkeypatch):
    alone = _predicted(BoostedTrees(_gbt()).fit(table), table)
    monkeypatch.setattr(boosting, "ALONE", 0)
    monkeypatch.setattr(boosting, "BLOCK", 200)
    monkeypatch.setattr(boosting, "REBASE", 2)
    held, kept = set(spark.sparkContext._jsc.getPersistentRDDs()), table.repartition(3)
    assert np.allclose(_predicted(BoostedTrees(_gbt()).fit(kept), table), alone, rtol=1e-9)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == held


def test_boosting_does_without_spark_trees(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("Spark ML's own fit takes some 0.5 core microseconds a row, level and tree")

    monkeypatch.setattr(GBTRegressor, "_fit", refused)
    cols = [F.lit("click").alias(c) if c in TRIPS_EV.categorical else (F.col("id") % (7 + k)).cast("double").alias(c) for k, c in enumerate(TRIPS_EV.features)]
    d = spark.range(500).select(*cols, (F.col("id") % 7).cast("double").alias(TRIPS_EV.target))
    model = BoostModel.fit(d, TRIPS_EV, {"iterations": 3, "depth": 3, "learning_rate": 0.5})
    assert len(model.pipeline.stages[-1].trees) == 3
    more = model.continue_fit(d, 2)
    assert len(more.pipeline.stages[-1].trees) == 5 and more.predict(d).count() == 500


def test_tables_sent_to_the_driver_do_not_grow_with_rows():
    binning = Binning(2, {0: np.array([0.5]), 1: np.arange(9.0)}, {}, 1024)
    rng, sizes = np.random.default_rng(0), []
    for n in (50, 5000):
        x = np.stack([rng.integers(0, 2, n), rng.integers(0, 10, n)], axis=1).astype(float)
        y = rng.normal(size=n)
        total, by_feature = boosting.counted([(binning.codes(x), y, np.zeros(n))], [], np.array([0, 1]), binning)
        assert total[0] == n and by_feature[1][0, 0].sum() == n and np.allclose(by_feature[0][1, 0].sum(), y.sum())
        sizes.append({f: h.shape for f, h in by_feature.items()})
    assert sizes[0] == sizes[1] == {0: (3, 1, 2), 1: (3, 1, 10)}


def test_rows_find_their_nodes():
    codes = np.array([[0, 1, 2, 3], [0, 1, 0, 1]], np.uint8)
    assert walk(codes, [[(1, 0, 1)], [(3, 1, np.array([1, 0], np.uint8))]]).tolist() == [2, 2, 7, 6]


def test_thresholds_and_odd_labels(spark, table):
    assert thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 5).tolist() == [1.5, 2.5]
    assert thresholds(np.array([1.0, 1.0]), 5).tolist() == [] and thresholds(np.array([np.nan, np.nan]), 5).tolist() == []
    assert len(thresholds(np.arange(1000.0), 31)) <= 31
    with pytest.raises(Exception, match="labels must be neither null nor NaN"):
        BoostedTrees(_gbt()).fit(table.withColumn("y", F.when(F.col("b") > 3, F.col("y"))))
    with pytest.raises(ValueError, match="one or more rows"):
        BoostedTrees(_gbt()).fit(table.limit(0))
