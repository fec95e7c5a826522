"""Decision tree (L1, L2, L9) and boosted trees with residual continuation (L3, L4, L7) on Spark ML."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.models.base import (
    FEATURES,
    PFX,
    PREDICTION,
    drop_internal,
    feature_stages,
    fit_pipeline,
    load_json,
    max_bins,
    save_json,
    spread,
    with_features,
)
from batchlens.models.boosting import BoostedTrees
from batchlens.models.treefiles import merged, pruned
from batchlens.operators.evaluate import metrics_dict
from batchlens.operators.preprocess import FitStats, fit_stats
from batchlens.spec import TableSpec

SEED = 42

# The reference's hyperparameter grids and tree defaults.
TREE_GRID = {"max_depth": [8, 12, 16], "min_samples_split": [10, 20], "min_samples_leaf": [5, 10]}
TREE_DEFAULT = {"max_depth": 12, "min_samples_split": 20, "min_samples_leaf": 10}
BOOST_GRID = {"iterations": [200, 300], "depth": [6, 8], "learning_rate": [0.03, 0.1]}


def grid(g: dict) -> list[dict]:
    keys = list(g)
    return [dict(zip(keys, v)) for v in itertools.product(*[g[k] for k in keys])]


@dataclass
class TreeModel:
    spec: TableSpec
    params: dict
    stats: FitStats
    pipeline: PipelineModel
    kind: str = "tree"

    @classmethod
    def fit(cls, df: DataFrame, spec: TableSpec, params: dict | None = None, stats: FitStats | None = None) -> "TreeModel":
        params = dict(params or TREE_DEFAULT)
        st = stats or fit_stats(df, spec)
        frame = with_features(df, st, "tree")
        dt = DecisionTreeRegressor(
            featuresCol=FEATURES, labelCol=spec.target, predictionCol=PREDICTION, seed=SEED, maxBins=max_bins(st),
            maxDepth=int(params["max_depth"]), minInstancesPerNode=int(params["min_samples_leaf"]),
        )
        grown = cls(spec, params, st, fit_pipeline(feature_stages(st, one_hot=True) + [dt], frame))
        return grown.cut_to(params)

    def cut_to(self, params: dict) -> "TreeModel":
        """L2: the tree of these parameters out of one that was grown at least as deep, with the same least leaf and no larger least split size. Spark has
        a least leaf size only; the least split size is what is undone here."""
        tree = pruned(self.pipeline.stages[-1], int(params["max_depth"]), int(params.get("min_samples_split", 2)))
        return TreeModel(self.spec, dict(params), self.stats, PipelineModel(stages=[*self.pipeline.stages[:-1], tree]))

    def predict(self, df: DataFrame) -> DataFrame:
        return drop_internal(self.pipeline.transform(with_features(df, self.stats, "tree")))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        save_json(path, {"kind": self.kind, "params": self.params, "stats": self.stats.to_json()})

    @classmethod
    def load(cls, path: str, spec: TableSpec) -> "TreeModel":
        m, _ = load_json(path)
        return cls(spec, m["params"], FitStats.from_json(m["stats"]), PipelineModel.load(f"{path}/pipeline"))


@dataclass
class BoostModel:
    """Gradient-boosted trees. A later batch's trees are fitted to the residuals and join the same ensemble (a continued fit on new
    data, as with an init model): one model, one pass over the rows, however many batches it has learned."""

    spec: TableSpec
    params: dict
    stats: FitStats
    pipeline: PipelineModel
    kind: str = "boost"

    @staticmethod
    def _gbt(spec: TableSpec, st: FitStats, params: dict, label: str) -> BoostedTrees:
        return BoostedTrees(GBTRegressor(
            featuresCol=FEATURES, labelCol=label, predictionCol=PREDICTION, seed=SEED, maxBins=max_bins(st),
            maxIter=int(params["iterations"]), maxDepth=int(params["depth"]), stepSize=float(params["learning_rate"]),
        ))

    @classmethod
    def fit(cls, df: DataFrame, spec: TableSpec, params: dict, stats: FitStats | None = None) -> "BoostModel":
        st = stats or fit_stats(df, spec)
        frame = spread(with_features(df, st, "boost").select(*[PFX + c for c in st.numerical + st.categorical], spec.target), "boost-rows")
        stages = feature_stages(st, one_hot=False) + [cls._gbt(spec, st, params, spec.target)]
        return cls(spec, dict(params), st, fit_pipeline(stages, frame))

    def _featurized(self, df: DataFrame) -> DataFrame:
        feats = PipelineModel(stages=self.pipeline.stages[:-1])
        return feats.transform(with_features(df, self.stats, "boost"))

    def predict(self, df: DataFrame) -> DataFrame:
        return drop_internal(self.pipeline.stages[-1].transform(self._featurized(df)))

    def continue_fit(self, df: DataFrame, iterations: int | None = None) -> "BoostModel":
        """Fit further trees on the new rows' residuals; the stored median/category stats stay."""
        fx = self.pipeline.stages[-1].transform(self._featurized(df))
        fx = fx.withColumn("__residual", F.col(self.spec.target) - F.col(PREDICTION)).drop(PREDICTION)
        p = dict(self.params)
        if iterations:
            p["iterations"] = iterations
        more = self._gbt(self.spec, self.stats, p, "__residual").fit(fx)
        ensemble = merged(self.pipeline.stages[-1], more)
        return BoostModel(self.spec, self.params, self.stats, PipelineModel(stages=[*self.pipeline.stages[:-1], ensemble]))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        save_json(path, {"kind": self.kind, "params": self.params, "stats": self.stats.to_json()})

    @classmethod
    def load(cls, path: str, spec: TableSpec) -> "BoostModel":
        m, _ = load_json(path)
        return cls(spec, m["params"], FitStats.from_json(m["stats"]), PipelineModel.load(f"{path}/pipeline"))


def tree_grid_models(sub: DataFrame, spec: TableSpec, g: dict | None = None) -> list[TreeModel]:
    """L2: the tree of every grid point, in the grid's order. One tree is grown for each leaf size, to the greatest depth; the others are
    that one without the splits that they may not have."""
    g, st = g or TREE_GRID, fit_stats(sub, spec)
    grown = {}
    for leaf in g["min_samples_leaf"]:
        most = {"max_depth": max(g["max_depth"]), "min_samples_split": 2, "min_samples_leaf": leaf}
        grown[leaf] = TreeModel.fit(sub, spec, most, st)
    return [grown[params["min_samples_leaf"]].cut_to(params) for params in grid(g)]


def search_tree(sub: DataFrame, val: DataFrame, spec: TableSpec, g: dict | None = None) -> tuple[dict, dict]:
    """L2: the first grid point with the lowest validation error."""
    best = None
    for m in tree_grid_models(sub, spec, g):
        vm = metrics_dict(m.predict(val), spec.target)
        if vm is not None and (best is None or vm["rmse"] < best[1]["rmse"]):
            best = (m.params, vm)
    if best is None:
        raise ValueError("No validation rows to select tree hyperparameters.")
    return best


def search_boost(sub: DataFrame, val: DataFrame, spec: TableSpec, g: dict | None = None) -> tuple[dict, dict]:
    """L4: one fit per (depth, rate) with the largest iteration count; a shorter ensemble is a prefix of it
    (same seed, depth, rate), so its validation error comes from ``evaluateEachIteration``. Grid order and
    the strict ``<`` (first wins a tie) follow the reference loop."""
    g = g or BOOST_GRID
    top = max(g["iterations"])
    fits: dict[tuple, tuple[BoostModel, list[float]]] = {}
    best, st = None, fit_stats(sub, spec)
    for params in grid(g):
        key = (params["depth"], params["learning_rate"])
        if key not in fits:
            m = BoostModel.fit(sub, spec, {"iterations": top, "depth": key[0], "learning_rate": key[1]}, st)
            mse = m.pipeline.stages[-1].evaluateEachIteration(m._featurized(val), "squared")
            fits[key] = (m, mse)
        m, mse = fits[key]
        rmse = float(mse[params["iterations"] - 1]) ** 0.5
        if best is None or rmse < best[1]:
            best = (params, rmse)
    if best is None:
        raise ValueError("empty boosting grid")
    params = best[0]
    m = fits[(params["depth"], params["learning_rate"])][0]
    if params["iterations"] != top:
        m = BoostModel.fit(sub, spec, params, st)
    return params, metrics_dict(m.predict(val), spec.target)
