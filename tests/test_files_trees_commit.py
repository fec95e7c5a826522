"""CSV files by header, rewritten trees, and batches that one updater commits."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from batchlens.models.treefiles import merged, pruned
from batchlens.plans import update
from batchlens.plans.train import prepare_batches, train_models
from batchlens.sources import files
from batchlens.sources.fixtures import trips_ev
from batchlens.sources.store import LEDGER, REGISTRY, UPDATES
from batchlens.spec import TRIPS_EV


def _write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, newline="")


def test_csv_files_with_other_columns_and_order(spark, tmp_path):
    f = tmp_path / "in"
    _write(f, "a.csv", "pickup_ts,dropoff_ts,total_amount,trip_distance\n2024-01-01 00:00:00,2024-01-01 00:10:00,10.5,1.5\n")
    _write(f, "b.csv", "pickup_ts,dropoff_ts,trip_distance,total_amount\n2024-01-02 00:00:00,2024-01-02 00:10:00,2.5,20.5\n")
    _write(f, "c.csv", '﻿"total_amount","a, ""b""\nc","trip_distance"\r\n30.5,"x, y",bad\r\n')
    _write(f, "empty.csv", "")
    _write(f, "head_only.csv", "pickup_ts,other\n")
    _write(f, "_hidden.csv", "total_amount\n99\n")
    df = files.read_batch_files(spark, str(f), TRIPS_EV)
    got = {r["source_batch"]: r for r in df.collect()}
    assert set(got) == {"a.csv", "b.csv", "c.csv"}
    assert [(got[k]["total_amount"], got[k]["trip_distance"]) for k in sorted(got)] == [(10.5, 1.5), (20.5, 2.5), (30.5, None)]
    assert got["c.csv"]['a, "b"\nc'] == "x, y" and got["a.csv"]["other"] is None
    assert [got[k]["pickup_ts"] is None for k in sorted(got)] == [False, False, True]


def test_csv_folder_without_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    df = files.read_trips(spark, str(tmp_path / "none"), TRIPS_EV)
    assert df.count() == 0 and set(TRIPS_EV.required) <= set(df.columns) and dict(df.dtypes)["total_amount"] == "double"


def test_header_longer_than_one_read():
    names = [f"column {k}" for k in range(5000)]
    text = ",".join(f'"{n}"' for n in names) + "\n1,2\n"
    assert files.first_record(text[:100], False) is None
    assert files.first_record(text, False) == names and files.first_record("a,a,", True) == ["a", "a1", "_c2"]


def _grid_rows(spark):
    d = spark.range(600).select((F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    d = d.withColumn("y", F.col("a") * F.col("b") + F.col("a") ** 2)
    return VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(d)


def _by_hand(rows, depth, leaf, split):
    """Predictions of a greedy variance tree over all thresholds between values, as lists."""
    def grow(part, level):
        mean = sum(y for _, _, y in part) / len(part)
        best = None
        if level < depth and len(part) >= split:
            base = sum((y - mean) ** 2 for _, _, y in part)
            for axis in (0, 1):
                for at in sorted({r[axis] for r in part})[:-1]:
                    l, r = [x for x in part if x[axis] <= at], [x for x in part if x[axis] > at]
                    if len(l) < leaf or len(r) < leaf:
                        continue
                    cost = sum(sum((y - sum(z for *_, z in s) / len(s)) ** 2 for *_, y in s) for s in (l, r))
                    if base - cost > 1e-7 and (best is None or cost < best[0] - 1e-7):
                        best = (cost, l, r)
        if best is None:
            return [(x, mean) for x in part]
        return grow(best[1], level + 1) + grow(best[2], level + 1)

    return sorted((x[2], round(p, 6)) for x, p in grow(rows, 0))


@pytest.mark.parametrize("depth,leaf,split", [(3, 5, 2), (4, 5, 60), (4, 5, 200), (2, 20, 100)])
def test_pruned_tree_is_the_tree_grown_with_that_split_size(spark, depth, leaf, split):
    d = _grid_rows(spark)
    deep = DecisionTreeRegressor(featuresCol="f", labelCol="y", maxDepth=4, minInstancesPerNode=leaf, maxBins=64).fit(d)
    cut = pruned(deep, depth, split)
    got = sorted((r["y"], round(r["prediction"], 6)) for r in cut.transform(d).collect())
    assert got == _by_hand([(r["a"], r["b"], r["y"]) for r in d.collect()], depth, leaf, split)


def test_merged_ensembles_add_up(spark, tmp_path):
    d = _grid_rows(spark)
    model = GBTRegressor(featuresCol="f", labelCol="y", maxIter=3, maxDepth=3, stepSize=0.3).fit(d)
    parts = [model]
    for k in range(3):
        part = d.where(F.col("a") % 4 == k)
        rest = model.transform(part).withColumn("r", F.col("y") - F.col("prediction")).drop("prediction")
        more = GBTRegressor(featuresCol="f", labelCol="r", maxIter=2, maxDepth=2, stepSize=0.3).fit(rest)
        parts.append(more)
        model = merged(model, more)
    model.save(str(tmp_path / "m"))
    model = GBTRegressionModel.load(str(tmp_path / "m"))
    assert model.getNumTrees == 3 + 3 * 2
    vectors = [r["f"] for r in d.limit(50).collect()]
    for v in vectors:
        assert model.predict(v) == pytest.approx(sum(p.predict(v) for p in parts), abs=1e-9)


def _trained(store, spec):
    grids = {"tree": {"max_depth": [3], "min_samples_split": [20], "min_samples_leaf": [10]}}
    prepare_batches(trips_ev(store.spark, "/root/testdata/sf0.001"), spec, store)
    train_models(store, spec, selected_models=["tree"], max_batches=2, grids=grids)


def test_two_updaters_of_one_batch(tmp_store, monkeypatch):
    """The second starts and ends while the first is about to commit: the first loses, and nothing of its run is seen."""
    store, spec, results = tmp_store, TRIPS_EV, []
    _trained(store, spec)
    commit = store.commit_batch

    def late(row):
        monkeypatch.setattr(store, "commit_batch", commit)
        results.append(update.process_next_batch(store, spec))
        return commit(row)

    monkeypatch.setattr(store, "commit_batch", late)
    lost = update.process_next_batch(store, spec)
    won = results[0]
    assert lost["status"] == "lost" and won["status"] == "updated" and lost["batch_name"] == won["batch_name"]
    runs = [r["run_id"] for r in store.read(LEDGER).where("kind = 'update'").collect()]
    assert len(runs) == 1
    assert store.read(UPDATES).count() == 2 and store.committed_log(UPDATES).count() == 1
    assert {r["run_id"] for r in store.committed_log(REGISTRY).where("update_strategy is not null").collect()} == set(runs)


def test_a_claim_without_its_ledger_row_is_completed(tmp_store, monkeypatch):
    """An updater dies between its claim and the ledger; the next one puts the row there and learns nothing twice."""
    store, spec = tmp_store, TRIPS_EV
    _trained(store, spec)
    append = store.append_rows

    def dies(name, rows):
        if name == LEDGER:
            raise RuntimeError("executor of the ledger row lost")
        append(name, rows)

    monkeypatch.setattr(store, "append_rows", dies)
    with pytest.raises(RuntimeError):
        update.process_next_batch(store, spec)
    monkeypatch.setattr(store, "append_rows", append)
    assert store.committed_log(UPDATES).count() == 0
    done = update.process_next_batch(store, spec)
    assert done["status"] == "updated" and done["completed_run"]
    assert store.read(LEDGER).where("kind = 'update'").count() == 1 and store.committed_log(UPDATES).count() == 1
    first = store.committed_log(UPDATES).first()["processed_batch_name"]
    after = update.process_next_batch(store, spec)
    assert after["status"] == "updated" and after["batch_name"] != first


def test_put_if_absent(tmp_store):
    assert tmp_store.put_if_absent("claims/b/1", "one") and not tmp_store.put_if_absent("claims/b/1", "two")
    assert tmp_store.text_of("claims/b/1") == "one"
