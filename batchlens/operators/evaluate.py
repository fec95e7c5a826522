"""Regression metrics and argmin selection as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """A13 + F9: rows with a label, MAE, RMSE, R^2 in one aggregate (R^2 as sklearn: 1 - SSE / SST,
    with a constant label giving 1.0 for a perfect fit and 0.0 otherwise). Empty when no row has a label."""
    d = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")
    )
    e = F.col("y") - F.col("p")
    agg = d.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("sse"),
        (F.var_pop("y") * F.count(F.lit(1))).alias("sst"),
    )
    r2 = (
        F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst"))
        .when(F.col("sse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return agg.where(F.col("rows") > 0).select("rows", "mae", "rmse", r2.alias("r2"))


def metrics_dict(df: DataFrame, label: str, prediction: str = "prediction") -> dict | None:
    row = regression_metrics(df, label, prediction).first()
    if row is None:
        return None
    return {"rows": int(row["rows"]), "mae": float(row["mae"]), "rmse": float(row["rmse"]), "r2": float(row["r2"])}


def argmin(df: DataFrame, metric: str, ordinal: str) -> DataFrame:
    """The row with the smallest ``metric``; the first by ``ordinal`` wins a tie (strict ``<`` scan)."""
    best = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(F.col(metric), F.col(ordinal)))
    return df.agg(best.alias("b")).where("b is not null").select("b.*")

