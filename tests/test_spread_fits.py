"""Tables that a fit reads in many passes are dealt over even files; the network's steps in place are the steps as written."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchlens.models import base
from batchlens.models.mlp import MLP_DEFAULT, Adam, design_rows, forward, init_weights
from batchlens.models.trees import BoostModel
from batchlens.operators.preprocess import fit_stats
from batchlens.spec import TRIPS_EV


@pytest.fixture()
def one_file(spark, monkeypatch):
    monkeypatch.setattr(base, "SPREAD_FROM", 400)
    monkeypatch.setattr(base, "FILE_ROWS", 25)
    cols = [F.lit("click").alias(c) if c in TRIPS_EV.categorical else (F.col("id") % (7 + k)).cast("double").alias(c) for k, c in enumerate(TRIPS_EV.features)]
    return spark.range(1000, numPartitions=1).select(*cols, F.col("id").cast("double").alias(TRIPS_EV.target))


def test_rows_of_the_network_are_spread(one_file):
    rows = design_rows(one_file, fit_stats(one_file, TRIPS_EV, scale=True), TRIPS_EV, 0.1)
    assert rows.count() == 1000 and rows.select(F.sum("__y")).first()[0] == 999 * 500
    sizes = [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 40 and max(sizes) <= 30


def test_rows_of_boosting_are_spread(one_file, monkeypatch):
    from batchlens.models import trees

    read = []
    monkeypatch.setattr(trees, "fit_pipeline", lambda stages, df: read.append(df))
    BoostModel.fit(one_file, TRIPS_EV, {"iterations": 2, "depth": 2, "learning_rate": 0.1})
    assert read[0].count() == 1000 and len(read[0].inputFiles()) == 40


def test_small_tables_stay_as_they_are(one_file):
    assert len(base.spread(one_file.limit(399), "small").inputFiles()) == 1


def test_steps_in_place_have_the_same_bits():
    rng = np.random.default_rng(3)
    x, y, params = rng.normal(size=(700, 5)), rng.normal(size=700), {**MLP_DEFAULT, "batch_size": 64}
    start = init_weights([5, 16, 8, 1])
    a, ws = Adam.start(start, params), [w.copy() for w in start]
    a.steps(x, y, np.random.default_rng(4))
    m, v, t = [np.zeros_like(w) for w in ws], [np.zeros_like(w) for w in ws], 0.0
    order = np.random.default_rng(4).permutation(700)
    for at in range(0, 700, 64):
        pick = order[at : at + 64]
        out, acts = forward(ws, x[pick])
        delta, t = ((out - y[pick]) / len(pick))[:, None], t + 1
        for i in (2, 1, 0):
            grads = (acts[i].T @ delta + params["alpha"] * ws[2 * i] / len(pick), delta.sum(axis=0))
            if i:
                delta = (delta @ ws[2 * i].T) * (acts[i] > 0)
            for j, g in zip((2 * i, 2 * i + 1), grads):
                m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.999 * v[j] + 0.001 * g * g
                ws[j] = ws[j] - params["learning_rate_init"] * ((m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8))
    assert np.array_equal(a.flat(), Adam(ws, m, v, t, params).flat())
    assert all(np.array_equal(p, q) for p, q in zip(start, init_weights([5, 16, 8, 1])))
