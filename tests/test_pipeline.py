"""End-to-end: prepare batches, train, update batch by batch, replay, score, summarise."""

from pyspark.sql import functions as F

from batchlens.plans.score import score
from batchlens.plans.summary import overview, quality_section, summary
from batchlens.plans.train import prepare_batches, train_models
from batchlens.plans.update import process_next_batch
from batchlens.sources.fixtures import trips_ev
from batchlens.sources.store import LEDGER, REGISTRY, UPDATES
from batchlens.spec import TRIPS_EV

from conftest import SF01

SMALL = {
    "tree": {"max_depth": [4, 6], "min_samples_split": [10], "min_samples_leaf": [5]},
    "boost": {"iterations": [3, 5], "depth": [3], "learning_rate": [0.1]},
    "mlp": {"hidden_layer_sizes": [(8,)], "alpha": [1e-4], "learning_rate_init": [1e-3]},
}


def test_train_update_replay_score(spark, tmp_store):
    spec = TRIPS_EV
    names = prepare_batches(trips_ev(spark, SF01), spec, tmp_store)
    assert names.count() == 5
    res = train_models(tmp_store, spec, max_batches=3, grids=SMALL, mlp_rounds=2)
    assert res["best"] is not None and res["trained_batch_count"] == 3
    reg = tmp_store.read(REGISTRY)
    assert reg.where(F.col("is_best")).count() == 1
    assert reg.select("model_key").distinct().count() == 3

    r4 = process_next_batch(tmp_store, spec, boost_iterations=2)
    assert r4["status"] == "updated" and r4["candidates"] == 3
    r5 = process_next_batch(tmp_store, spec, boost_iterations=2)
    assert r5["status"] == "updated"
    before = (tmp_store.read(LEDGER).count(), tmp_store.read(REGISTRY).count(), tmp_store.read(UPDATES).count())
    assert process_next_batch(tmp_store, spec)["status"] == "no_new_batches"
    after = (tmp_store.read(LEDGER).count(), tmp_store.read(REGISTRY).count(), tmp_store.read(UPDATES).count())
    assert before == after  # replay is a no-op

    out = score(tmp_store.batches().drop(spec.batch_col), spec, tmp_store)
    m = out["metrics"].first()
    assert m["rows_with_target"] > 0 and m["rmse"] > 0

    ov = overview(tmp_store).first()
    assert ov["logged_updates"] == 2 and ov["best_model_key"] in ("boost", "tree", "mlp")
    tot, per = quality_section(tmp_store)
    assert tot.first()["processed_batches"] == 2
    assert summary(tmp_store).count() > 10


def test_generate_rules_first_batches_and_no_rules(spark, tmp_store):
    import pytest

    from batchlens.operators.batching import assign_batches
    from batchlens.plans.train import generate_rules
    from batchlens.sources.fixtures import trips_li_dup
    from batchlens.spec import TRIPS_LI

    b = assign_batches(trips_li_dup(spark, SF01), TRIPS_LI)
    out = generate_rules(b, TRIPS_LI, max_batches=150, store=tmp_store)
    assert out["rules"].count() == 15 and out["top_rules"].count() == 5
    cfg = out["config"].first()
    assert cfg["batch_count"] == 150
    eb = assign_batches(trips_ev(spark, SF01), TRIPS_EV)
    with pytest.raises(ValueError, match="no rule reaches|no itemset reaches"):
        generate_rules(eb, TRIPS_EV)


def _store_of(spark, tmp_store, **kw):
    spec = TRIPS_EV.with_(**kw)
    prepare_batches(trips_ev(spark, SF01), spec, tmp_store)
    return spec


def test_reading_a_batch_prunes_partitions(spark, tmp_store):
    spec = _store_of(spark, tmp_store)
    one = tmp_store.batch_table(spec).first()
    rows = tmp_store.batch_rows(one["batch_id"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and rows.count() == one["row_count"]


def test_drift_on_write(spark, tmp_store):
    tmp_store.append_rows(UPDATES, [{"run_id": "a"}])
    tmp_store.append_rows(UPDATES, [{"run_id": "b", "new_figure": 1.5, "note": "x"}])
    got = {r["run_id"]: r["new_figure"] for r in tmp_store.read(UPDATES).collect()}
    assert got == {"a": None, "b": 1.5}


def test_crash_before_the_ledger_leaves_nothing(spark, tmp_store, monkeypatch):
    from batchlens.sources.store import QUALITY, Store

    spec = _store_of(spark, tmp_store)
    train_models(tmp_store, spec, max_batches=3, grids=SMALL, selected_models=["tree"])
    put = Store.append_rows

    def broken(self, name, rows):
        if name == LEDGER:
            raise RuntimeError("lost")
        put(self, name, rows)

    monkeypatch.setattr(Store, "append_rows", broken)
    try:
        process_next_batch(tmp_store, spec)
    except RuntimeError:
        pass
    monkeypatch.setattr(Store, "append_rows", put)
    assert tmp_store.read(QUALITY).count() == 1 and tmp_store.committed_log(QUALITY).count() == 0
    assert tmp_store.committed_log(UPDATES).count() == 0
    assert process_next_batch(tmp_store, spec)["status"] == "updated"
    assert tmp_store.committed_log(QUALITY).count() == 1 and overview(tmp_store).first()["logged_updates"] == 1
    row = tmp_store.committed_log(REGISTRY).where("update_strategy is not null").first()
    assert row["test_batch"].startswith("batch_0004")  # the retrained tree was tested on its own last batch, not on the first model's


def test_models_on_a_file_uri(spark, tmp_path):
    from batchlens.models.mlp import MLPModel
    from batchlens.models.trees import TreeModel
    from batchlens.operators.cleaning import prepare

    df = prepare(trips_ev(spark, SF01), TRIPS_EV).df.limit(300)
    for m in (TreeModel.fit(df, TRIPS_EV), MLPModel.fit(df, TRIPS_EV, {"hidden_layer_sizes": (4,)}, max_rounds=1)):
        path = f"file://{tmp_path}/{m.kind}"
        m.save(path)
        a = m.predict(df).agg(F.sum("prediction")).first()[0]
        assert abs(type(m).load(path, TRIPS_EV).predict(df).agg(F.sum("prediction")).first()[0] - a) < 1e-6 * max(1, abs(a))


def test_mlp_empty_partitions_and_signal(spark):
    from batchlens.models.mlp import search_mlp, train_together
    from batchlens.operators.evaluate import metrics_dict
    from batchlens.spec import TableSpec

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 2))
    pdf = pd.DataFrame({"u": x[:, 0], "v": x[:, 1], "y": 3 * x[:, 0] - x[:, 1] ** 2, "h": 1.0, "w": 2.0, "m": 3.0, "d": 4.0})
    spec = TableSpec("a", "b", "y", ("u", "v"), (), hour_col="h", weekday_col="w", month_col="m", duration_col="d")
    df = spark.createDataFrame(pdf).repartition(64, F.floor("u"))  # most partitions are empty
    models = train_together(df, spec, [{"hidden_layer_sizes": (16,), "learning_rate_init": 0.01, "max_iter": 25}, {"hidden_layer_sizes": (4,), "max_iter": 2}])
    assert metrics_dict(models[0].predict(df), "y")["r2"] > 0.8
    assert models[0].continue_fit(df.where("u > 100")).weights[0].shape == models[0].weights[0].shape  # no rows at all
    best = search_mlp(df, df, spec, {"hidden_layer_sizes": [(4,), (8,)], "alpha": [1e-4], "learning_rate_init": [0.01]}, max_rounds=3)
    assert best[0]["hidden_layer_sizes"] in [(4,), (8,)]


def test_reports_and_own_medians(spark, tmp_store):
    from batchlens.plans.train import profile_batches

    spec = _store_of(spark, tmp_store)
    profile_batches(tmp_store.batches(), spec, tmp_store)
    train_models(tmp_store, spec, max_batches=3, grids=SMALL, selected_models=["boost"])
    process_next_batch(tmp_store, spec, boost_iterations=2, medians="own")
    sections = {r[0] for r in summary(tmp_store).select("section").distinct().collect()}
    assert sections == {"overview", "data_quality", "quality_by_batch", "training", "training_history", "update", "update_history", "best_model"}
    keys = {r.key: r.value for r in summary(tmp_store).where("section = 'best_model'").collect()}
    assert "passenger_count" in keys["features"] and "medians" in keys["preprocessing"] and keys["batch_rows"] != "n/a"
    a = score(tmp_store.batches().drop(spec.batch_col), spec, tmp_store, fitted={"distance": 1e9, "target": 1e9, "duration": 1e9}, medians="own")
    assert a["metrics"].first()["rows_with_target"] > 0
