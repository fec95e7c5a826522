"""Reports over the log tables as DataFrames (``summary``); the Markdown rendering is not rebuilt."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.functions.exprs import text_or_na
from batchlens.models.registry import committed
from batchlens.operators.quality import quality_totals
from batchlens.sources.store import QUALITY, TRAINING, UPDATES, Store, latest_per

QUALITY_COLS = [
    "batch_name", "row_count", "missing_total", "duplicate_count", "negative_target_count",
    "invalid_duration_count", "invalid_coordinate_count",
]


def best_records(log: DataFrame) -> DataFrame:
    """the records marked best."""
    return log.where(F.col("is_best"))


def latest_record(log: DataFrame, order: str) -> DataFrame:
    """The record with the newest ``order``, none of an empty log."""
    return log.agg(F.max_by(F.struct(*log.columns), F.col(order)).alias("r")).where("r is not null").select("r.*")


def history(log: DataFrame, columns: list[str]) -> DataFrame:
    """A log's records in time order."""
    return log.select(*columns).orderBy("created_at")


def latest_quality(store: Store) -> DataFrame:
    """One row per batch, the newest record (a batch profiled twice is not two batches)."""
    return latest_per(store.committed_log(QUALITY), "batch_name", "created_at")


def overview(store: Store) -> DataFrame:
    """G1: counts of logged batches, training records and updates, plus the current best model."""
    q = latest_quality(store).agg(F.count(F.lit(1)).alias("logged_quality_batches"))
    t = store.committed_log(TRAINING).agg(F.count(F.lit(1)).alias("logged_training_records"))
    u = store.committed_log(UPDATES).agg(F.count(F.lit(1)).alias("logged_updates"))
    reg = committed(store).where(F.col("is_best"))
    b = reg.agg(F.max_by(F.struct("model_name", "model_key", "version"), F.struct("created_at", "ordinal")).alias("b"))
    row = {**q.first().asDict(), **t.first().asDict(), **u.first().asDict()}
    best = b.first()["b"]
    row.update(
        {
            "best_model_name": best["model_name"] if best else None,
            "best_model_key": best["model_key"] if best else None,
            "best_model_version": best["version"] if best else None,
        }
    )
    return store.spark.createDataFrame([row])


def quality_section(store: Store) -> tuple[DataFrame, DataFrame]:
    """G2 (D1 fixed: aggregates the real columns): totals and the per-batch table."""
    latest = latest_quality(store)
    return quality_totals(latest), latest.select(*QUALITY_COLS).orderBy("batch_name")


def training_section(store: Store) -> tuple[DataFrame, DataFrame]:
    """The latest best record and the training history."""
    t = store.committed_log(TRAINING)
    cols = ["created_at", "model_name", "model_key", "train_rows", "test_rows", "test_rmse", "test_mae", "test_r2", "is_best"]
    return latest_record(best_records(t), "created_at"), history(t, cols)


def update_section(store: Store) -> tuple[DataFrame, DataFrame]:
    """The latest update record and the update history."""
    u = store.committed_log(UPDATES)
    cols = [
        "created_at", "processed_batch_index", "processed_batch_name", "pre_update_rmse", "post_update_batch_rmse", "post_update_model_key",
        "update_error",
    ]
    return latest_record(u, "created_at"), history(u, cols)


def best_model_card(store: Store) -> DataFrame:
    """(key, value) rows of the best model's registry entry; NULL -> 'n/a'."""
    reg = committed(store).where(F.col("is_best"))
    r = reg.agg(F.max_by(F.struct(*reg.columns), F.struct("created_at", "ordinal")).alias("r")).select("r.*")
    keys = [c for c in r.columns if c not in ("run_id",)]
    stack = ", ".join(f"'{c}', cast(`{c}` as string)" for c in keys)
    return r.selectExpr(f"stack({len(keys)}, {stack}) as (key, value)").withColumn("value", text_or_na("value"))


def summary(store: Store) -> DataFrame:
    """Every section as (section, ordinal, key, value) text rows: overview, quality totals and the per-batch table, the latest best
    training record and the training history, the latest update and the update history, the best model's card. ``ordinal`` is the
    record's place in its section."""

    def kv(section: str, df: DataFrame, order: str | None = None) -> DataFrame:
        cols = df.columns
        place = F.row_number().over(Window.orderBy(order)) if order else F.lit(1)  # report tables: a row for each batch or record
        stack = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
        return df.withColumn("__at", place).selectExpr("__at", f"stack({len(cols)}, {stack}) as (key, value)").select(
            F.lit(section).alias("section"), F.col("__at").cast("long").alias("ordinal"), "key", text_or_na("value").alias("value"),
        )

    totals, per_batch = quality_section(store)
    best, trained = training_section(store)
    last, updates = update_section(store)
    card = best_model_card(store).select(F.lit("best_model").alias("section"), F.lit(1).cast("long").alias("ordinal"), "key", "value")
    parts = [
        kv("overview", overview(store)), kv("data_quality", totals), kv("quality_by_batch", per_batch, "batch_name"), kv("training", best),
        kv("training_history", trained, "created_at"), kv("update", last), kv("update_history", updates, "created_at"), card,
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
