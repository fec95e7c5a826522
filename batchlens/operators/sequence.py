"""Order-dependent helpers that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_value_in_group(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    out: str,
    bucket: Column,
) -> DataFrame:
    """``lead(value) over (partition by key order by *order)`` without a task per key.

    A plain window puts every row of a key into one task; with one key holding a third of the table that
    task is the job. Here rows are windowed per (key, bucket), where ``bucket`` is a monotone function of
    the first ``order`` column (e.g. the day), so a hot key spreads over its buckets. The last row of each
    bucket then takes the first row of the key's next non-empty bucket, found on the small per-(key, bucket)
    table. Exactly equal to the plain window.
    """
    b = "__bucket"
    rows = df.withColumn(b, bucket)
    w = Window.partitionBy(key, b).orderBy(*order)
    rows = rows.withColumn(out, F.lead(value).over(w))
    firsts = rows.groupBy(key, b).agg(F.min_by(F.col(value), F.struct(*order)).alias("__first"))
    nxt = firsts.withColumn("__next", F.lead("__first").over(Window.partitionBy(key).orderBy(b))).select(
        key, b, "__next"
    )
    rows = rows.join(nxt, [key, b], "left")
    return rows.withColumn(out, F.coalesce(F.col(out), F.col("__next"))).drop(b, "__next")
