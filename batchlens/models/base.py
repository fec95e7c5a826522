"""Shared model plumbing: feature columns from fitted statistics, Spark ML feature stages, persistence."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.functions.quantiles import quantiles
from batchlens.operators.preprocess import MISSING, FitStats, cat_text
from batchlens.session import kept_table

PFX = "__x_"
FEATURES = "__features"
PREDICTION = "prediction"
#: Least rows of a file of a table that a fit reads in many passes, from SPREAD_FROM rows on, and the most files of a core and in all.
FILE_ROWS = 20_000
SPREAD_FROM = 100_000
CORE_FILES = 8
FILES = 480


def feature_exprs(df: DataFrame, st: FitStats, mode: str) -> dict[str, Column]:
    """Prefixed model inputs: imputed numerics (scaled for 'mlp'), categories as text.

    mode 'boost': NULL category -> 'missing'; 'tree' / 'mlp': NULL category -> fitted mode.
    """
    out: dict[str, Column] = {}
    for c in st.numerical:
        x = F.coalesce(F.col(c).cast("double"), F.lit(st.medians.get(c)).cast("double"))
        if mode == "mlp":
            x = (x - F.lit(st.means.get(c, 0.0))) / F.lit(st.stds.get(c, 0.0) or 1.0)
        out[PFX + c] = x
    for c in st.categorical:
        fill = MISSING if mode == "boost" else st.modes.get(c)
        out[PFX + c] = F.coalesce(cat_text(df, c), F.lit(fill))
    return out


def with_features(df: DataFrame, st: FitStats, mode: str) -> DataFrame:
    return df.withColumns(feature_exprs(df, st, mode))


def spread(df: DataFrame, what: str) -> DataFrame:
    """The rows stored once for many passes. A table that comes out of a shuffle has few files of uneven size, and a file is one task whatever the number
    of cores; a larger one is dealt row by row over even files, the same number for each core. Spark puts the files of a core together to one task. It counts a
    file as 4 MB more than it has, up to 128 MB a task, so files beyond CORE_FILES would make more tasks than cores, and the last of them a round of their own."""
    held = kept_table(df, what)
    rows = held.count()
    return held if rows < SPREAD_FROM else kept_table(held.repartition(even_files(rows, df.sparkSession.sparkContext.defaultParallelism)), what)


def even_files(rows: int, cores: int) -> int:
    """Files for this many rows: a multiple of the cores where there are enough rows."""
    wanted = min(FILES, cores * CORE_FILES, rows // FILE_ROWS)
    return wanted // cores * cores or wanted


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def feature_stages(st: FitStats, one_hot: bool) -> list:
    """StringIndexer (unseen -> an extra, last index) [+ OneHotEncoder that drops that index: unseen -> all zeros] + assembler."""
    cats = st.categorical
    idx = [f"{PFX}{c}__idx" for c in cats]
    stages = []
    cat_cols = []
    if cats:
        stages.append(
            StringIndexer(
                inputCols=[PFX + c for c in cats], outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        cat_cols = idx
        if one_hot:
            ohe = [f"{PFX}{c}__ohe" for c in cats]
            stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
            cat_cols = ohe
    stages.append(
        VectorAssembler(inputCols=[PFX + c for c in st.numerical] + cat_cols, outputCol=FEATURES, handleInvalid="keep")
    )
    return stages


def max_bins(st: FitStats) -> int:
    card = max([len(v) for v in st.categories.values()] + [0])
    return max(32, card + 2)


def save_json(path: str, obj: dict, data: bytes | None = None) -> None:
    """A model's description (and weights) as a one-row table under its path, on whatever store the path names."""
    row = [(json.dumps(obj, default=str), data)]
    SparkSession.active().createDataFrame(row, "meta string, data binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_json(path: str) -> tuple[dict, bytes | None]:
    row = SparkSession.active().read.parquet(f"{path}/meta").first()
    return json.loads(row["meta"]), bytes(row["data"]) if row["data"] is not None else None


def own_medians(model, df: DataFrame):
    """The model with the medians of ``df`` itself where it has any, for frames that are filled from their own values."""
    got = quantiles(df, {c: 0.5 for c in model.stats.numerical if c in df.columns})
    return replace(model, stats=replace(model.stats, medians={**model.stats.medians, **{c: v for c, v in got.items() if v is not None}}))


def fit_pipeline(stages: list, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(df)
