"""Fitted preprocessing statistics (exact) and their application as column expressions.

Spark ML's ``Imputer`` uses an approximate median and rejects strings, and ``StandardScaler`` divides by
the sample deviation; the reference semantics are the exact median, the most frequent category (ties to
the smallest value) and the population deviation. So the statistics are fitted here with one or two
aggregate jobs, stored as plain JSON, and applied as built-in expressions; one-hot encoding and vector
assembly then use Spark ML stages.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from batchlens.functions.quantiles import grouped_quantiles, quantiles
from batchlens.spec import TableSpec

MISSING = "missing"


def cat_text(df: DataFrame, c: str) -> Column:
    """Category as text; numeric categories go through LONG so 1 and 1.0 are the same category."""
    dt = df.schema[c].dataType
    if isinstance(dt, NumericType):
        return F.col(c).cast("long").cast("string")
    if isinstance(dt, StringType):
        return F.col(c)
    return F.col(c).cast("string")


@dataclass
class FitStats:
    numerical: list[str]
    categorical: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)

    def to_json(self) -> dict:
        return asdict(self)

    @classmethod
    def from_json(cls, d: dict) -> "FitStats":
        return cls(**d)


def median_frame(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact medians of ``columns``, long format (feature, stat, num_value, text_value)."""
    wide = grouped_quantiles(df, [], {f"c{i}": (c, 0.5) for i, c in enumerate(columns)})
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {stack}) as (feature, num_value)").select(
        "feature", F.lit("median").alias("stat"), "num_value", F.lit(None).cast("string").alias("text_value")
    )


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value text, numeric sort key, count) for every non-null category of ``columns``.

    Rows are bounded by the categories' cardinality; partial aggregation keeps the shuffle that small."""
    def one(c):
        num = isinstance(df.schema[c].dataType, NumericType)
        nk = F.col(c).cast("long") if num else F.lit(None).cast("long")
        return F.struct(F.lit(c).alias("feature"), cat_text(df, c).alias("val"), nk.alias("nk"))

    return (
        df.select(F.explode(F.array(*[one(c) for c in columns])).alias("p"))
        .where(F.col("p.val").isNotNull())
        .groupBy("p.feature", "p.val", "p.nk")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def mode_frame(counts: DataFrame) -> DataFrame:
    """Most frequent category per feature; a tie goes to the smallest value (numeric order for numbers)."""
    return counts.groupBy("feature").agg(
        F.min_by("val", F.struct(-F.col("n"), F.col("nk"), F.col("val"))).alias("text_value")
    ).select("feature", F.lit("mode").alias("stat"), F.lit(None).cast("double").alias("num_value"), "text_value")


def stats_frame(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A16 as a table: median rows for numerical features, mode rows for categorical ones."""
    num = [c for c in spec.numerical if c in df.columns]
    cat = [c for c in spec.categorical if c in df.columns]
    parts = []
    if num:
        parts.append(median_frame(df, num))
    if cat:
        parts.append(mode_frame(category_counts(df, cat)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_stats(df: DataFrame, spec: TableSpec, scale: bool = False) -> FitStats:
    """Exact medians of the numerical features, category lists and modes of the categorical ones,
    and with ``scale`` the mean / population deviation after median imputation. Only these few numbers
    reach the driver."""
    num = [c for c in spec.numerical if c in df.columns]
    cat = [c for c in spec.categorical if c in df.columns]
    st = FitStats(num, cat)
    if num:
        st.medians = quantiles(df, {c: 0.5 for c in num})
    if cat:
        counts = category_counts(df, cat).collect()
        for c in cat:
            vals = [(r["val"], r["nk"], r["n"]) for r in counts if r["feature"] == c]
            st.categories[c] = [v for v, _, _ in sorted(vals, key=lambda t: (t[1] is None, t[1], t[0]))]
            st.modes[c] = min(vals, key=lambda t: (-t[2], t[1] if t[1] is not None else 0, t[0]))[0] if vals else None
    if scale and num:
        imp = impute_numeric(df, st)
        row = imp.agg(
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(num)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(num)],
        ).first()
        st.means = {c: float(row[f"m_{i}"] or 0.0) for i, c in enumerate(num)}
        st.stds = {c: float(row[f"s_{i}"] or 0.0) for i, c in enumerate(num)}
    return st


def impute_numeric(df: DataFrame, st: FitStats) -> DataFrame:
    """P16 numeric: NULL -> fitted median (a column with no median stays NULL)."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(st.medians.get(c)).cast("double")) for c in st.numerical}
    )


def impute_categorical(df: DataFrame, st: FitStats, fill: str | None = None) -> DataFrame:
    """Categories as text; NULL -> the fitted mode (or the constant ``fill``, e.g. 'missing')."""
    return df.withColumns(
        {c: F.coalesce(cat_text(df, c), F.lit(fill if fill is not None else st.modes.get(c))) for c in st.categorical}
    )


def scale_numeric(df: DataFrame, st: FitStats) -> DataFrame:
    """(x - mean) / population std; a zero deviation divides by 1."""
    out = {}
    for c in st.numerical:
        sd = st.stds.get(c, 0.0) or 1.0
        out[c] = (F.col(c) - F.lit(st.means.get(c, 0.0))) / F.lit(sd)
    return df.withColumns(out)


def boosting_frame(df: DataFrame, st: FitStats) -> DataFrame:
    """Categories as text with NULL -> 'missing', numerics <- fitted medians."""
    return impute_numeric(impute_categorical(df, st, fill=MISSING), st)


def tree_frame(df: DataFrame, st: FitStats) -> DataFrame:
    """Tree pipeline input: median / mode imputation."""
    return impute_numeric(impute_categorical(df, st), st)


def mlp_frame(df: DataFrame, st: FitStats) -> DataFrame:
    """MLP pipeline input: median / mode imputation, then population-std scaling."""
    return scale_numeric(tree_frame(df, st), st)
