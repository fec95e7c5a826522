"""Temporal hold-out and tail validation split, without positional indexes.

DataFrames have no row order, so "the last batch" and "the last 1000 rows" are defined by an explicit
total order: (batch key, event time, end time, then every other column). After CLEAN's full-row distinct
that key is unique.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from batchlens.spec import TableSpec


def total_order(df: DataFrame, spec: TableSpec) -> list[str]:
    head = [c for c in (spec.batch_col, spec.event_ts, spec.end_ts) if c in df.columns]
    return head + sorted(c for c in df.columns if c not in head)


def holdout_split(batched: DataFrame, spec: TableSpec, max_batches: int | None = None):
    """(train rows, test rows, test batch key). The test batch is the last one in time order.

    Both sides are plain comparisons with the test key, so a table partitioned by it is pruned.
    """
    keys = batched.select(spec.batch_col).distinct()
    if max_batches is not None:
        if max_batches < 2:
            raise ValueError("a hold-out split takes two or more batches")
        keys = keys.orderBy(spec.batch_col).limit(max_batches)
    last = keys.agg(F.max(spec.batch_col).alias("test"), F.count(F.lit(1)).alias("n")).first()
    if last["n"] < 2:
        raise ValueError("there are fewer than two batches to split")
    k, test_key = F.col(spec.batch_col), last["test"]
    return batched.where(k < F.lit(test_key)), batched.where(k == F.lit(test_key)), test_key


def validation_rows(n: int, share: float = 0.2, tail: int = 1000) -> int:
    """How many of ``n`` ordered rows validate: the last ``tail``, or the last ``share`` of a table that holds fewer than two
    tails; never all and never none."""
    wanted = tail if n >= 2 * tail else n - int(n * (1 - share))
    return max(1, min(wanted, n - 1))


@dataclass
class TailSplit:
    subtrain: DataFrame
    validation: DataFrame
    n: int
    k: int


def _literal(v, dtype) -> Column:
    """Typed literal; naive timestamps go through ISO text so no time zone is applied on the way."""
    if v is not None and isinstance(dtype, TimestampNTZType):
        return F.lit(v.isoformat(sep=" ")).cast(dtype)
    return F.lit(v).cast(dtype)


def _key(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def tail_split(df: DataFrame, spec: TableSpec, val_fraction: float = 0.2, min_val_rows: int = 1000) -> TailSplit:
    """The last ``validation_rows(n)`` rows in total order validate.

    One count job, one bounded TakeOrdered (k rows at most, k <= max(min_val_rows, 0.2 n for small n))
    to find the boundary key, then two filters. No global sort, no single-partition window.
    """
    order = total_order(df, spec)
    n = df.count()
    if n < 2:
        raise ValueError("a tail split takes two or more rows")
    k = validation_rows(n, val_fraction, min_val_rows)
    tail = df.select(_key(order).alias("__k")).orderBy(F.col("__k").desc()).limit(k)
    boundary = tail.agg(F.min("__k").alias("b")).first()["b"]
    lit = F.struct(*[_literal(boundary[i], df.schema[c].dataType).alias(c) for i, c in enumerate(order)])
    key = _key(order)
    return TailSplit(df.where(key < lit), df.where(key >= lit), n, k)
