"""Exact quantiles (linear interpolation, as pandas ``quantile`` and DuckDB ``quantile_cont``), by group, by a proven bracket.

1. One pass makes a mergeable summary of every group and column (``percentile_approx``, whose ranks are off by at most n / ACCURACY) and
   takes a bracket from it that holds the wanted ranks: a few ranks more than the bound to both sides of the quantile, or all values of a small group.
   A row for each group is kept.
2. A second pass counts what lies below a group's bracket (a partial row for each task and group) and keeps only the values inside, equal ones
   as one row with their count: a share of about 6 / ACCURACY of a large group. The values themselves are never shuffled.
3. A running sum over the values inside gives their ranks; the two at the wanted ranks are interpolated with Spark's own ``percentile``
   formula. A bracket that did not hold its ranks would raise an error; none gives another value.

``quantiles`` is the same over one group, as a dict; the driver sees the brackets and the results only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.session import kept_table

#: The summary's ranks are off by at most 1 / ACCURACY of a group's values.
ACCURACY = 4000
#: (least number of values, share of them to both sides of the quantile): in each case the share less the summary's error is 2 ranks at least.
MARGINS = ((4 * ACCURACY, 2 / ACCURACY), (400, 0.01), (40, 0.1))

_INF = float("inf")


def _brackets(df: DataFrame, keys: list[str], xs: list[str], wants: list[tuple[int, float]]) -> DataFrame:
    """A row for each group: keys, and n, lo, hi of every want (column number, q)."""
    sides = [(q - m, q + m) for _, q in wants for _, m in MARGINS]
    asked = sorted({p for pair in sides for p in pair if 0 < p < 1}) or [0.5]
    aggs = []
    for i, x in enumerate(xs):
        v = F.when(F.isnan(x), F.lit(_INF)).otherwise(F.col(x))
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"), F.percentile_approx(v, asked, ACCURACY).alias(f"p{i}")]
    out = []
    for j, (i, q) in enumerate(wants):
        lo, hi = F.col(f"min{i}"), F.col(f"max{i}")
        for least, m in reversed(MARGINS):
            enough = F.col(f"n{i}") >= least
            if q - m > 0:
                lo = F.when(enough, F.col(f"p{i}")[asked.index(q - m)]).otherwise(lo)
            if q + m < 1:
                hi = F.when(enough, F.col(f"p{i}")[asked.index(q + m)]).otherwise(hi)
        hi = F.when(hi == _INF, F.lit(float("nan"))).otherwise(hi)
        out += [F.col(f"n{i}").alias(f"n{j}"), lo.alias(f"lo{j}"), hi.alias(f"hi{j}")]
    return df.groupBy(*keys).agg(*aggs).select(*keys, *out)


def grouped_quantiles(df: DataFrame, by: list[str], wants: dict[str, tuple[str, float]], weight: Column | None = None) -> DataFrame:
    """One row per group with a double column per name of ``wants`` (name -> (column, q)).

    NULLs are left out; a group without values of a column has NULL there, a group without any values has no row. NULL is a group
    of its own. ``weight`` counts a row that often (small numbers: the row is repeated)."""
    columns = sorted({c for c, _ in wants.values()})
    keys = [f"k{i}" for i in range(len(by))]
    xs = [f"x{i}" for i in range(len(columns))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], *[F.col(c).cast("double").alias(x) for c, x in zip(columns, xs)],
                     *([] if weight is None else [F.explode(F.array_repeat(F.lit(1), weight.cast("int"))).alias("w")])).drop("w")
    places = [(columns.index(c), float(q)) for c, q in wants.values()]
    bounds = _brackets(rows, keys, xs, places)
    if keys:
        bounds = kept_table(bounds, "brackets")
        told = bounds.select(*[F.col(k).alias(f"b_{k}") for k in keys], *[c for c in bounds.columns if c not in keys])
        same = [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in keys]
        rows = rows.join(told, same)
    else:  # one group: its few numbers become literals
        one = bounds.first()
        rows = rows.withColumns({c: F.lit(one[c]).cast("long" if c.startswith("n") else "double") for c in bounds.columns})
    cells = F.array(*[
        F.struct(F.lit(j).alias("j"), F.col(xs[i]).alias("x"), F.col(f"lo{j}").alias("lo"), F.col(f"hi{j}").alias("hi"), F.col(f"n{j}").alias("total"))
        for j, (i, _) in enumerate(places)
    ])
    cells = rows.select(*keys, F.explode(cells).alias("c")).where("c.x <= c.hi")
    inside = cells.groupBy(*keys, "c.j", F.when(F.col("c.x") >= F.col("c.lo"), F.col("c.x")).alias("x")).agg(F.count("*").alias("n"), F.max("c.total").alias("total"))
    upto = F.sum("n").over(Window.partitionBy(*keys, "j").orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    ranked = inside.withColumn("upto", upto).where("x is not null")
    aggs, out = [], []
    for j, (name, (_, q)) in enumerate(wants.items()):
        mine = F.col("j") == j
        pos = (F.col("total") - 1) * F.lit(float(q))

        def at(rank: Column) -> Column:
            return F.max(F.when(mine & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("x")))

        aggs += [at(F.floor(pos)).alias(f"lo{j}"), at(F.ceil(pos)).alias(f"hi{j}"), F.max(F.when(mine, pos)).alias(f"pos{j}")]
        lo, hi, p = F.col(f"lo{j}"), F.col(f"hi{j}"), F.col(f"pos{j}")
        mid = (F.ceil(p) - p) * lo + (p - F.floor(p)) * hi
        value = F.when((F.ceil(p) == F.floor(p)) | (lo == hi), lo).otherwise(mid)
        failed = F.raise_error(F.lit(f"the bracket of {name} does not hold its ranks")).cast("double")
        out.append(F.when(p.isNull(), F.lit(None).cast("double")).when(lo.isNull() | hi.isNull(), failed).otherwise(value).alias(name))
    return ranked.groupBy(*keys).agg(*aggs).select(*[F.col(k).alias(c) for c, k in zip(by, keys)], *out)


def quantiles(df: DataFrame, targets: dict[str, float | list[float]]) -> dict[str, float | list[float] | None]:
    """Exact quantiles of the non-null values per column; ``None`` for an all-null or empty column."""
    wants = {}
    for c, qs in targets.items():
        for i, q in enumerate(qs if isinstance(qs, list) else [qs]):
            wants[f"{c}__{i}"] = (c, q)
    if not wants:
        return {}
    row = grouped_quantiles(df, [], wants).first()
    out: dict[str, float | list[float] | None] = {}
    for c, qs in targets.items():
        got = [row[f"{c}__{i}"] for i in range(len(qs) if isinstance(qs, list) else 1)]
        out[c] = None if got[0] is None else (got if isinstance(qs, list) else got[0])
    return out


def quantile(df: DataFrame, column: str, q: float) -> float | None:
    return quantiles(df, {column: q})[column]
