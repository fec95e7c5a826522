"""Calendar batches: period key, minimum-size filter, ordinal and readable batch names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.functions.exprs import batch_name, period_start
from batchlens.session import kept_table
from batchlens.spec import TableSpec

def assign_batches(df: DataFrame, spec: TableSpec, min_rows: int | None = None) -> DataFrame:
    """A1: drop rows without both timestamps, key each row by its period, drop periods under ``min_rows``.

    The kept periods are counted once (a partial row for each period and task is shuffled) and stored, a row for each calendar
    period; rows are semi-joined with them. Spark knows the stored table's size, so it broadcasts it while it is small."""
    min_rows = spec.min_batch_rows if min_rows is None else min_rows
    rows = df.na.drop(subset=[spec.event_ts, spec.end_ts]).withColumn(
        spec.batch_col, period_start(spec.event_ts, spec.batch_freq)
    )
    kept = rows.groupBy(spec.batch_col).count().where(F.col("count") >= min_rows).select(spec.batch_col)
    return rows.join(kept_table(kept, "periods"), spec.batch_col, "left_semi").select(*rows.columns)


def batch_list(batched: DataFrame, spec: TableSpec) -> DataFrame:
    """W1 + S9 names: one row per kept batch with its 1-based ordinal in time order.

    The window runs over the small per-batch table, never over the fact rows.
    """
    per = batched.groupBy(spec.batch_col).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(spec.event_ts).alias("pickup_min"),
        F.max(spec.event_ts).alias("pickup_max"),
    )
    return with_names(per, spec).select(spec.batch_col, "batch_index", "batch_name", "row_count", "pickup_min", "pickup_max")


def with_names(per_batch: DataFrame, spec: TableSpec, first: str = "pickup_min", last: str = "pickup_max") -> DataFrame:
    """Ordinal and readable name of every row of a per-batch table, from its first and last event times."""
    ordinal = F.row_number().over(Window.orderBy(spec.batch_col))
    return per_batch.withColumn("batch_index", ordinal).withColumn("batch_name", batch_name("batch_index", first, last))


def first_batches(batched: DataFrame, spec: TableSpec, n: int) -> DataFrame:
    """rows of the first ``n`` batches in time order: one predicate on the batch key, which prunes partitions."""
    if n < 1:
        raise ValueError("the number of first batches has to be positive")
    last = batched.select(spec.batch_col).distinct().orderBy(spec.batch_col).limit(n).agg(F.max(spec.batch_col)).first()[0]
    if last is None:
        raise ValueError("there is no batch with enough rows")
    return batched.where(F.col(spec.batch_col) <= F.lit(last))
