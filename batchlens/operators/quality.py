"""Per-batch data-quality profile and batch metadata, for all batches at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.functions.exprs import iso_text
from batchlens.functions.quantiles import grouped_quantiles
from batchlens.operators.batching import with_names
from batchlens.operators.features import make_time_features
from batchlens.session import kept_table
from batchlens.spec import TableSpec


def null_cells(columns) -> Column:
    """Number of NULL cells in a row over ``columns``."""
    return reduce(lambda a, b: a + b, [F.isnull(c).cast("int") for c in columns], F.lit(0))


def _row_groups(batched: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Identical rows of a batch (NULL = NULL) collapsed to one row with its multiplicity ``__n``.

    Every count of the profile is a function of (row, multiplicity): counts become sums of ``__n``, duplicates are
    ``__n - 1``. So the counts are one scan and one shuffle by full-row hash (balanced even when one batch holds most
    rows), then a per-batch aggregate that moves one partial row per batch and task.
    """
    return batched.groupBy(key, *cols).agg(F.count(F.lit(1)).alias("__n"))


def count_columns(df: DataFrame, spec: TableSpec, cols: list[str]) -> list[Column]:
    """The profile's counts over rows with their multiplicity ``__n``; missing cells are counted in ``cols``."""
    n = F.col("__n")

    def count_where(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(F.lit(0).cast("long"))).cast("long")

    dur = F.col(spec.duration_col)
    none = F.lit(False)
    return [
        F.sum(n).cast("long").alias("row_count"),
        F.sum(null_cells(cols) * n).cast("long").alias("missing_total"),
        F.sum(n - 1).cast("long").alias("duplicate_count"),
        count_where(F.col(spec.distance) < 0 if spec.distance in df.columns else none).alias("negative_trip_distance_count"),
        count_where(F.col(spec.target) < 0).alias("negative_target_count"),
        count_where(dur.isNull() | (dur <= 0)).alias("invalid_duration_count"),
        count_where(invalid_coordinates(df, spec) if _has_coordinates(df, spec) else none).alias("invalid_coordinate_count"),
    ]


def quality_profile(batched: DataFrame, spec: TableSpec) -> DataFrame:
    """A9 for every batch of ``batched`` (rows keyed by ``spec.batch_col``).

    Counts are over the raw columns plus the four generated ones. The q99s are exact and come from
    ``grouped_quantiles`` over a narrow stored table of their columns; no batch is held in one task.
    """
    key = spec.batch_col
    raw_cols = [c for c in batched.columns if c != key]
    df = make_time_features(_row_groups(batched, key, raw_cols), spec)
    cols = raw_cols + [c for c in spec.generated if c not in raw_cols]
    counts = df.groupBy(key).agg(*count_columns(df, spec, cols))
    dist = spec.distance if spec.distance in df.columns else None
    wants = {"target_q99": (spec.target, 0.99), "duration_q99": (spec.duration_col, 0.99)}
    if dist:
        wants["trip_distance_q99"] = (dist, 0.99)
    narrow = make_time_features(batched, spec).select(key, *[c for c, _ in wants.values()])
    q99 = grouped_quantiles(kept_table(narrow, "q99"), [key], wants).withColumnRenamed(key, "__key")
    out = counts.join(q99, F.col(key).eqNullSafe(F.col("__key")), "left")
    distance_q99 = F.col("trip_distance_q99") if dist else F.lit(None).cast("double").alias("trip_distance_q99")
    return out.select(*counts.columns, distance_q99, "target_q99", "duration_q99")


def _has_coordinates(df: DataFrame, spec: TableSpec) -> bool:
    return bool(spec.coordinates) and all(b.column in df.columns for b in spec.coordinates)


def invalid_coordinates(df: DataFrame, spec: TableSpec) -> Column:
    """Any coordinate missing or out of its bounds."""
    bad = reduce(lambda a, b: a | b, [~F.col(b.column).between(b.lo, b.hi) for b in spec.coordinates])
    return F.coalesce(bad, F.lit(True))


def batch_meta(batched: DataFrame, spec: TableSpec) -> DataFrame:
    """A2: rows, columns, first/last event time as ISO text, missing cells, duplicates (raw columns) and the batch's name, all
    from one row grouping: ordinal and name come from the small per-batch result."""
    key = spec.batch_col
    cols = [c for c in batched.columns if c != key]
    n = F.col("__n")
    out = _row_groups(batched, key, cols).groupBy(key).agg(
        F.sum(n).cast("long").alias("row_count"),
        F.lit(len(cols)).alias("column_count"),
        F.min(spec.event_ts).alias("__first"),
        F.max(spec.event_ts).alias("__last"),
        F.sum(null_cells(cols) * n).cast("long").alias("missing_total"),
        F.sum(n - 1).cast("long").alias("duplicate_count"),
    )
    return with_names(out, spec, "__first", "__last").select(
        key, "row_count", "column_count", iso_text("__first").alias("pickup_min"), iso_text("__last").alias("pickup_max"),
        "missing_total", "duplicate_count", "batch_name",
    )


def quality_totals(profile: DataFrame) -> DataFrame:
    """A14 / G2 totals over a quality table (latest row per batch if it holds repeats)."""
    return profile.agg(
        F.count(F.lit(1)).alias("processed_batches"),
        F.sum("row_count").cast("long").alias("total_rows"),
        F.sum("missing_total").cast("long").alias("total_missing"),
        F.sum("duplicate_count").cast("long").alias("total_duplicates"),
        F.sum("negative_target_count").cast("long").alias("total_negative_target"),
        F.sum("invalid_duration_count").cast("long").alias("total_invalid_duration"),
        F.sum("invalid_coordinate_count").cast("long").alias("total_invalid_coordinates"),
    )
