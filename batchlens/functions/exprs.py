"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FREQS = {"week": "week", "W": "week", "day": "day", "D": "day", "hour": "hour", "H": "hour", "month": "month", "M": "month"}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column) -> Column:
    """Zone-free timestamps out of text, bad values -> NULL (pandas ``errors='coerce'``); no session zone is applied."""
    return col(c).cast("string").try_cast("timestamp_ntz")


def hour_of(ts: str | Column) -> Column:
    return F.hour(col(ts))


def weekday_mon0(ts: str | Column) -> Column:
    """Weekday with Monday = 0 (pandas ``dt.weekday``; Spark ``dayofweek`` is Sunday = 1)."""
    return F.weekday(col(ts))


def month_of(ts: str | Column) -> Column:
    return F.month(col(ts))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Fractional minutes from ``start`` to ``end`` at microsecond precision."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(60_000_000.0)


def period_start(ts: str | Column, freq: str = "week") -> Column:
    """Calendar period key: a DATE (weeks start on Monday, as pandas ``to_period('W')``), or for hours a zone-free timestamp."""
    unit = _FREQS.get(freq)
    if unit is None:
        raise ValueError(f"unsupported batch frequency {freq!r}")
    day = col(ts).cast("date")
    if unit == "hour":
        zero = F.lit(0)
        return F.make_timestamp_ntz(F.year(day), F.month(day), F.day(day), F.hour(col(ts)), zero, zero)
    return day if unit == "day" else F.trunc(day, unit)


def iso_text(ts: str | Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS`` text, NULL stays NULL."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def day_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd")


def batch_name(ordinal: str | Column, start: str | Column, end: str | Column) -> Column:
    """``batch_NNNN_<first day>_<last day>``: the readable batch name."""
    return F.concat(
        F.lit("batch_"), F.lpad(col(ordinal).cast("string"), 4, "0"), F.lit("_"), day_text(start), F.lit("_"), day_text(end)
    )


def parse_batch_range(name: str | Column) -> tuple[Column, Column]:
    """(start, end) dates from the last two ``_`` parts of a batch name; unparsable -> 9999-12-31."""
    stem = F.regexp_replace(col(name), r"\.[^._]*$", "")
    start = F.regexp_extract(stem, r"_([^_]+)_[^_]+$", 1)
    end = F.regexp_extract(stem, r"_([^_]+)$", 1)
    ok = F.size(F.split(stem, "_")) >= 4
    far = F.lit("9999-12-31").cast("date")
    s = F.try_to_date(start, "yyyy-MM-dd")
    e = F.try_to_date(end, "yyyy-MM-dd")
    valid = ok & s.isNotNull() & e.isNotNull()
    return F.when(valid, s).otherwise(far), F.when(valid, e).otherwise(far)


def nan_to_null(c: str | Column) -> Column:
    """SQL NULL for NaN so comparisons follow pandas (NaN >= 0 is true in Spark)."""
    x = col(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def text_or_na(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit("n/a"))


def fixed4(c: str | Column) -> Column:
    return F.printf(F.lit("%.4f"), col(c).cast("double"))

