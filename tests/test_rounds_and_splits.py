"""A split evaluates the adapter once; files of a fit are a multiple of the cores; the network's last pass takes no steps in vain."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from batchlens import catalog
from batchlens.models import base, mlp
from batchlens.models.base import PFX
from batchlens.operators.preprocess import FitStats
from batchlens.spec import TRIPS_EV

SMALL_NET = {"hidden_layer_sizes": (4,), "n_iter_no_change": 2, "tol": 10.0, "max_iter": 9}


def _rows(spark, n=300):
    cols = [F.lit("click").alias(c) if c in TRIPS_EV.categorical else (F.col("id") % (7 + k)).cast("double").alias(c) for k, c in enumerate(TRIPS_EV.features)]
    return spark.range(n, numPartitions=1).select(*cols, (F.col("id") % 7).cast("double").alias(TRIPS_EV.target))


def test_split_reads_the_stored_trips(spark, tmp_path, monkeypatch):
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).cast("timestamp_ntz")
    events = spark.range(800).select(
        F.col("id").alias("event_id"), start.alias("ts"), (F.col("id") % 3).alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"), F.concat(F.lit('{"k": '), (F.col("id") % 9).cast("string"), F.lit("}")).alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    assign = catalog.assign_batches
    monkeypatch.setattr(catalog, "assign_batches", lambda df, spec: seen.append(df) or assign(df, spec))
    train, test, _ = catalog._split_prepared(spark, str(tmp_path), "trips_ev")
    assert train.count() > 0 and test.count() > 0
    assert len(seen) == 1 and "Window" not in seen[0]._jdf.queryExecution().toString()


def test_files_are_a_multiple_of_the_cores():
    assert base.even_files(33_000_000, 12) == 96  # 480 files were packed to 19 tasks for 12 cores
    assert base.even_files(33_000_000, 96) == 480 and base.even_files(33_000_000, 100) == 400
    assert base.even_files(500_000, 12) == 24 and base.even_files(120_000, 12) == 6


def _passes(monkeypatch):
    passes, one_round = [], mlp.one_round

    def told(blocks, states, st, rnd, train):
        passes.append((rnd, train))
        return one_round(blocks, states, st, rnd, train)

    monkeypatch.setattr(mlp, "one_round", told)
    return passes


def test_a_pass_that_ends_the_fit_takes_no_steps(spark, monkeypatch):
    passes = _passes(monkeypatch)
    mlp.MLPModel.fit(_rows(spark), TRIPS_EV, SMALL_NET)
    assert passes == [(0, True), (1, True), (2, False)]


def test_a_pass_that_turned_out_not_to_be_the_last_takes_its_steps(spark, monkeypatch):
    passes = _passes(monkeypatch)
    r2 = iter([0.1, 0.1, 50.0, 50.0, 50.0, 50.0])  # the third score, taken by a pass that may be the last, is a new best one
    scores = {}
    monkeypatch.setattr(mlp, "_r2", lambda f: scores.setdefault(f.tobytes(), next(r2)) if f.tobytes() not in scores else scores[f.tobytes()])
    model = mlp.MLPModel.fit(_rows(spark), TRIPS_EV, SMALL_NET)
    assert passes == [(0, True), (1, True), (2, False), (2, True), (3, True), (4, False)]
    assert all(np.isfinite(w).all() for w in model.weights)


def test_rounds_read_kept_blocks_of_numbers(spark, monkeypatch):
    held, decoded = spark.sparkContext._jsc.getPersistentRDDs, []
    one_round = mlp.one_round
    monkeypatch.setattr(mlp, "one_round", lambda blocks, *a: decoded.append(blocks.is_cached) or one_round(blocks, *a))
    before = len(held())
    mlp.MLPModel.fit(_rows(spark), TRIPS_EV, SMALL_NET)
    assert decoded == [True, True, True] and len(held()) == before
    st = mlp.fit_stats(_rows(spark), TRIPS_EV, scale=True)
    row = mlp.row_blocks(mlp.design_rows(_rows(spark), st, TRIPS_EV, 0.1), st).first()
    assert len(row["x"]) == 300 * 8 * len(TRIPS_EV.numerical) and len(row["p"]) == 1200 and len(row["y"]) == 2400 and len(row["v"]) == 300


def test_coded_rows_decode_to_the_design():
    st = FitStats(["n"], ["a", "b", "c"], categories={"a": ["x", "y"], "b": [], "c": ["1", "2", "3"]})
    pdf = pd.DataFrame({PFX + "n": [0.5, np.nan, -2.0, 7.0], PFX + "a": ["y", None, "z", "x"], PFX + "b": ["q", "q", None, "q"], PFX + "c": ["3", "1", "2", "4"]})
    assert np.array_equal(mlp.decoded(*mlp.coded(pdf, st), st), mlp.design(pdf, st), equal_nan=True)
    assert mlp.decoded(*mlp.coded(pdf, st), st).sum(axis=1)[[0, 2, 3]].tolist() == [2.5, -1.0, 8.0]
