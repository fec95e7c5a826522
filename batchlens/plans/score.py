"""Scoring a table with the published best model (``inference``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.models.base import own_medians
from batchlens.models.registry import best_row, load_row
from batchlens.operators.cleaning import prepare
from batchlens.operators.evaluate import regression_metrics
from batchlens.operators.features import coerce_timestamps, nan_as_null, normalize_columns, require_columns
from batchlens.sources.store import INFERENCE, PREDICTIONS, Store, new_run_id
from batchlens.spec import TableSpec


def score(
    df: DataFrame,
    spec: TableSpec,
    store: Store,
    require_target: bool = False,
    write: bool = True,
    fitted: dict | None = None,
    medians: str = "stored",
) -> dict:
    """Prepare (scoring mode keeps rows without a target unless ``require_target``), predict with the best model, write
    predictions keyed by run id, and metrics over the rows that have a target. Written predictions are read back, so rows
    are predicted once. ``fitted`` passes another table's cleaning thresholds; ``medians='own'`` fills a boosting model's
    inputs from the table's own medians."""
    df = nan_as_null(coerce_timestamps(normalize_columns(df, spec), spec))
    prepared = prepare(df, spec, require_target=require_target, fitted=fitted).df
    model = load_row(best_row(store), spec)
    require_columns(prepared, [*model.stats.numerical, *model.stats.categorical], "the model's features")
    if medians == "own" and model.kind == "boost":
        model = own_medians(model, prepared)
    pred = model.predict(prepared)
    run = new_run_id()
    if write:
        pred.write.parquet(store.path(PREDICTIONS, run))
        pred = store.spark.read.schema(pred.schema).parquet(store.path(PREDICTIONS, run))
    out = {"run_id": run, "predictions": pred}
    if spec.target in pred.columns:
        out["metrics"] = regression_metrics(pred, spec.target).withColumnRenamed("rows", "rows_with_target")
        if write:
            store.append(INFERENCE, out["metrics"].withColumn("run_id", F.lit(run)).withColumn("created_at", F.current_timestamp()))
    return out
