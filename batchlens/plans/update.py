"""Test-then-train on the next unprocessed batch (``update``), idempotent by batch id.

Order of effects (M7): quality record -> model folders (inert) -> registry rows -> update record -> ledger row. Models and logs
are read for runs that the ledger has only, so a crash anywhere before the ledger append leaves no visible change, and
replaying a committed batch is a no-op. Of two updaters that work on one batch, the first to claim it commits; the other's run is never seen.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from batchlens.models.base import own_medians
from batchlens.models.registry import (
    best_row,
    build_model_registry,
    committed,
    current_row,
    load_row,
    params_json,
)
from batchlens.operators.cleaning import prepare
from batchlens.operators.evaluate import metrics_dict
from batchlens.operators.features import require_columns
from batchlens.operators.quality import quality_profile
from batchlens.plans.train import prepare_split
from batchlens.session import cut_lineage
from batchlens.sources.store import QUALITY, REGISTRY, UPDATES, Store, new_run_id, now
from batchlens.spec import TableSpec


def next_batch(store: Store, spec: TableSpec):
    """(the earliest pending batch or None, number of batches). Only the batch index and the ledger are read."""
    return store.pending(spec).orderBy(spec.batch_col).limit(1).first(), store.batch_table(spec).count()


def process_next_batch(
    store: Store,
    spec: TableSpec,
    selection: str = "prequential",
    boost_iterations: int | None = None,
    medians: str = "stored",
) -> dict:
    """M2-M7 for one batch. ``selection='prequential'`` publishes the candidate whose pre-update error on the batch was lowest;
    ``'in_sample'`` the lowest error after fitting it. ``medians='own'`` fills the boosting model's inputs from the batch's own
    medians instead of the stored ones.

    A batch that the ledger knows in part (late files) is learned from its later rows only and profiled whole."""
    if committed(store).limit(1).count() == 0:
        raise ValueError("no model has been trained in this store yet")
    nxt, n_batches = next_batch(store, spec)
    if nxt is None:
        return {"status": "no_new_batches", "available_batches": n_batches}
    key_val, name, index = nxt[spec.batch_col], nxt["batch_name"], nxt["batch_index"]
    done = store.complete_claim(nxt["batch_id"], nxt["upto_epoch"])
    if done is not None:  # its updater died after all was written
        return {"status": "updated", "batch_name": name, "completed_run": done}
    run = new_run_id()
    batches = store.batches()
    batch = store.batch_rows(nxt["batch_id"])
    new = batch if nxt["done_epoch"] is None else store.batch_rows(nxt["batch_id"], nxt["done_epoch"])

    prof = quality_profile(batch, spec).first().asDict()
    store.append_rows(QUALITY, [{**prof, "batch_name": name, "run_id": run, "created_at": now()}])

    prepared = cut_lineage(prepare(new, spec).df)
    best = best_row(store)
    pre = None
    if best is not None:
        pre = metrics_dict(load_row(best, spec).predict(prepared), spec.target)

    results, error = [], None
    try:
        reg = build_model_registry()
        for i, key in enumerate(reg):
            row = current_row(store, key)
            if row is None:
                continue
            model = load_row(row, spec)
            require_columns(prepared, [*model.stats.numerical, *model.stats.categorical], f"features of {key}")
            if key == "boost" and medians == "own":
                model = own_medians(model, prepared)
            before = metrics_dict(model.predict(prepared), spec.target)
            if key == "boost":
                updated, strategy, extra = model.continue_fit(prepared, boost_iterations), "boost_continue_fit", {}
            elif key == "mlp":
                updated, strategy, extra = model.continue_fit(prepared), "mlp_partial_fit", {}
            else:  # L9: full retrain on all available batches up to this one, saved hyperparameters
                upto = batches.where(F.col(spec.batch_col) <= F.lit(key_val))
                p = prepare_split(upto, spec)
                updated = type(model).fit(p.train, spec, model.params)
                test = metrics_dict(updated.predict(p.test), spec.target) or {}
                strategy = "tree_full_retrain"  # fixed value
                held = store.batch_table(spec).where(F.col(spec.batch_col) == F.lit(p.test_key)).first()
                extra = {"test_batch": held["batch_name"], "test_rmse": test.get("rmse"), "test_mae": test.get("mae"), "test_r2": test.get("r2"),
                         "train_rows": p.train_rows, "test_rows": p.test_rows, "train_batches": p.train_batches}
            after = metrics_dict(updated.predict(prepared), spec.target)
            version = new_run_id()
            path = store.model_path(key, version)
            updated.save(path)
            results.append(
                {
                    **{k: row[k] for k in ("model_key", "model_name", "model_type", "val_rmse", "val_mae", "val_r2",
                                           "test_rmse", "test_mae", "test_r2", "train_rows", "test_rows",
                                           "train_batches", "test_batch", "features", "numerical", "categorical",
                                           "preprocessing")},
                    **extra,
                    "version": version, "path": path, "params": params_json(model.params),
                    "batch_rmse": after["rmse"] if after else None, "batch_mae": after["mae"] if after else None,
                    "batch_r2": after["r2"] if after else None, "update_strategy": strategy, "is_best": False,
                    "selection_strategy": selection, "batch_rows": after["rows"] if after else 0,
                    "run_id": run, "created_at": now(), "ordinal": i,
                    "_pre_rmse": before["rmse"] if before else None, "_rows": after["rows"] if after else 0,
                }
            )
    except ValueError as exc:  # D5: recorded, the batch still counts as processed
        error = str(exc)
        results = []

    chosen = None
    crit = "_pre_rmse" if selection == "prequential" else "batch_rmse"
    for r in results:
        if r[crit] is not None and (chosen is None or r[crit] < chosen[crit]):
            chosen = r
    rows = [{k: v for k, v in r.items() if not k.startswith("_")} for r in results]
    if chosen is not None:
        rows.append({**{k: v for k, v in chosen.items() if not k.startswith("_")}, "is_best": True,
                     "created_at": now(), "ordinal": len(results)})
    store.append_rows(REGISTRY, rows)

    # The update record's field names.
    rec = {
        "created_at": now(), "processed_batch_index": index, "processed_batch_name": name,
        "available_batches_after_update": index, "quality_row_count": prof["row_count"],
        "quality_missing_total": prof["missing_total"], "quality_duplicate_count": prof["duplicate_count"],
        "quality_negative_target_count": prof["negative_target_count"],
        "quality_invalid_duration_count": prof["invalid_duration_count"],
        "quality_invalid_coordinate_count": prof["invalid_coordinate_count"],
        "incremental_update_attempted": best is not None, "updated_candidate_models": len(results),
        "update_error": error, "run_id": run,
    }
    if pre is not None:
        rec.update({"pre_update_model_name": best["model_name"], "pre_update_model_key": best["model_key"],
                    "pre_update_batch_rows": pre["rows"], "pre_update_mae": pre["mae"],
                    "pre_update_rmse": pre["rmse"], "pre_update_r2": pre["r2"]})
    if chosen is not None:
        rec.update({"post_update_model_name": chosen["model_name"], "post_update_model_key": chosen["model_key"],
                    "post_update_model_type": chosen["model_type"], "post_update_strategy": chosen["update_strategy"],
                    "post_update_batch_rows": chosen["_rows"], "post_update_model_version": chosen["version"],
                    "post_update_batch_mae": chosen["batch_mae"], "post_update_batch_rmse": chosen["batch_rmse"],
                    "post_update_batch_r2": chosen["batch_r2"]})
    store.append_rows(UPDATES, [rec])
    won = store.commit_batch(
        {"batch_id": nxt["batch_id"], "batch_start": key_val, "batch_name": name, "upto_epoch": nxt["upto_epoch"], "run_id": run,
         "kind": "update" if nxt["done_epoch"] is None else "late_rows",
         "status": "failed" if error else "updated", "processed_at": now()}
    )
    if not won:  # another updater was faster; what this run has written stays unseen
        return {"status": "lost", "batch_name": name}
    return {"status": "updated", "batch_name": name, "pre_update": pre, "chosen": chosen and chosen["model_key"],
            "update_error": error, "candidates": len(results)}
