"""The ordered cleaning chain.

Order matters: each upper-quantile trim is computed over the survivors of the earlier steps, so the chain
is three dependent thresholds (distance -> target -> duration). The few columns that they need are stored once, in a narrow
table; each threshold is one exact quantile of one of its columns (``functions.quantiles``), so the source is read twice, whatever lies
behind it. The final plan carries the thresholds as literals, which Catalyst can push into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.functions.quantiles import quantile
from batchlens.operators.features import check_feature_columns, make_time_features
from batchlens.session import kept_table
from batchlens.spec import TableSpec


@dataclass
class Cleaned:
    df: DataFrame
    thresholds: dict[str, float | None] = field(default_factory=dict)


def coordinates_ok(df: DataFrame, spec: TableSpec) -> Column | None:
    """All configured coordinate columns that exist: non-null and inside their inclusive bounds."""
    present = [b for b in spec.coordinates if b.column in df.columns]
    if not present:
        return None
    cond = F.lit(True)
    for b in present:
        cond = cond & F.col(b.column).isNotNull() & F.col(b.column).between(b.lo, b.hi)
    return cond


def quantile_trim(df: DataFrame, column: str, q: float, fitted: float | None = None):
    """Keep rows with ``column <= quantile(q)``; no-op if the column is absent or all-null (NULLs drop)."""
    if column not in df.columns:
        return df, None
    thr = fitted if fitted is not None else quantile(df, column, q)
    if thr is None:
        return df, None
    return df.where(F.col(column) <= F.lit(thr)), thr


def clean(
    df: DataFrame,
    spec: TableSpec,
    *,
    require_target: bool = True,
    dedup: bool = True,
    fitted: dict[str, float | None] | None = None,
) -> Cleaned:
    """CLEAN: null keys -> distance >= 0 -> distance trim -> target >= 0 -> target trim -> coordinates ->
    duration > 0 -> duration trim -> full-row distinct.

    ``fitted`` reuses thresholds from another dataset (e.g. train) instead of this one's own.
    ``require_target=False`` is the scoring mode: rows without a target are kept and the target is neither
    filtered nor trimmed.
    """
    fitted = fitted or {}
    keys = [spec.event_ts, spec.end_ts] + ([spec.target] if require_target else [])
    base = df.na.drop(subset=keys)
    dist = spec.distance if spec.distance and spec.distance in df.columns else None
    if dist:
        base = base.where(F.col(dist).isNotNull() & (F.col(dist) >= 0))
    coords = coordinates_ok(base, spec)
    duration = spec.duration_col if spec.duration_col in base.columns else None
    trims = [("distance", dist, spec.distance_q)] if dist else []
    trims += [("target", spec.target, spec.target_q)] if require_target else []
    trims += [("duration", duration, spec.duration_q)] if duration else []
    probe = base  # the same rows as ``cur``, with the columns that thresholds need only
    if any(fitted.get(name) is None for name, _, _ in trims):
        narrow = list(dict.fromkeys(c for _, c, _ in trims))
        probe = kept_table(base.select(*narrow, (F.lit(True) if coords is None else coords).alias("__inside")), "clean")
    thr: dict[str, float | None] = {}
    cur = base
    for name, column, q in trims:
        if name == "target":
            cur, probe = (d.where(F.col(column) >= 0) for d in (cur, probe))
        if name == "duration":
            cur, probe = (d.where(F.col(column) > 0) for d in (cur if coords is None else cur.where(coords), probe.where("__inside") if "__inside" in probe.columns else probe))
        _, thr[name] = quantile_trim(probe, column, q, fitted.get(name))
        cur, probe = (quantile_trim(d, column, q, thr[name])[0] if thr[name] is not None else d for d in (cur, probe))
    if coords is not None and not duration:
        cur = cur.where(coords)
    if dedup:
        cur = cur.dropDuplicates()
    return Cleaned(cur, thr)


def prepare(df: DataFrame, spec: TableSpec, **kw) -> Cleaned:
    """Time features, then CLEAN, then the generated-column guard."""
    res = clean(make_time_features(df, spec), spec, **kw)
    check_feature_columns(res.df, spec)
    return res
