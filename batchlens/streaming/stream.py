"""Structured Streaming entry points.

``run_stream`` (M2-M7): new trip files land in a folder; each micro-batch is keyed into calendar batches and written to the batch
store as its epoch (a replayed epoch replaces itself); then the update step runs for every pending batch in time
order. The file source hands files over in modification-time order, so the order is taken from the batch index and the
ledger, never from arrival. A file of a batch that is closed already reopens it: the ledger knows up to which epoch a
batch was learned, and the update step learns the later rows and profiles the whole batch again.

``quality_stream`` (M8): the per-batch quality counts as a streaming aggregation over weekly event-time
windows (Monday start) with a watermark, for sources that never stop.

``closed_weeks`` (M8): the exact counts, duplicates among them, of every week that the watermark has closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from batchlens.functions.exprs import period_start
from batchlens.operators.features import make_time_features
from batchlens.operators.quality import count_columns, invalid_coordinates, null_cells
from batchlens.models.registry import committed
from batchlens.plans.train import load_source
from batchlens.plans.update import process_next_batch
from batchlens.session import kept_table
from batchlens.sources.store import BATCH_INDEX, Store
from batchlens.spec import TableSpec


class StreamStore(Store):
    """Batch store fed by micro-batches; the minimum-size rule holds for whole calendar batches over all epochs."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, hold_latest: bool = True):
        super().__init__(spark, root)
        self.spec, self.hold_latest = spec, hold_latest

    def least_rows(self, spec: TableSpec) -> int:
        return spec.min_batch_rows

    def batch_table(self, spec: TableSpec) -> DataFrame:
        table = super().batch_table(spec)
        if self.hold_latest:  # the newest batch may still be filling up
            index = self.spark.read.parquet(self.path(BATCH_INDEX))
            latest = index.agg(F.max(spec.batch_col)).first()[0]
            table = table.where(F.col(spec.batch_col) < F.lit(latest))
        return table

    def batches(self) -> DataFrame:
        full = kept_table(self.batch_table(self.spec).select("batch_id"), "batches")
        return self._rows().join(full, "batch_id", "left_semi").drop("epoch", "batch_id")


def run_stream(
    spark: SparkSession,
    store_root: str,
    spec: TableSpec,
    landing: str,
    schema: StructType,
    checkpoint: str,
    fmt: str = "parquet",
    max_files_per_trigger: int = 1,
    **update_kw,
) -> int:
    """Consume everything in ``landing`` (``availableNow``), updating models batch by batch; returns the
    number of updates. A replayed epoch replaces only its own folders and what the ledger has is not done again, so a restart is
    safe."""
    store = StreamStore(spark, store_root, spec)
    done = {"n": 0}

    def drain(s: Store) -> None:
        if committed(s).limit(1).count() == 0:  # nothing trained yet: batches only accumulate
            return
        while (status := process_next_batch(s, spec, **update_kw)["status"]) != "no_new_batches":
            done["n"] += status == "updated"

    def handle(df: DataFrame, epoch_id: int) -> None:
        rows = load_source(df, spec).withColumn(spec.batch_col, period_start(spec.event_ts, spec.batch_freq))
        store.write_batches(rows, spec, epoch_id)
        drain(store)

    q = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    drain(StreamStore(spark, store_root, spec, hold_latest=False))  # source drained: the last week is whole
    return done["n"]


def quality_stream(stream: DataFrame, spec: TableSpec, watermark: str = "1 day", accuracy: int = 10_000) -> DataFrame:
    """M8: the running weekly quality profile. Event time is cast to TIMESTAMP (UTC session) for the watermark.

    State is bounded: the q99s are sketches of the given accuracy (a batch's exact ones come from ``quality_profile``), and duplicates are rows
    less an estimate of distinct row hashes."""
    ts = F.col(spec.event_ts).cast("timestamp")
    dur = (F.unix_micros(F.col(spec.end_ts).cast("timestamp")) - F.unix_micros(ts)) / F.lit(60_000_000.0)
    cols = list(stream.columns)
    df = stream.withColumn("__ts", ts).withColumn(spec.duration_col, dur)
    dist = spec.distance if spec.distance in cols else None
    has_coordinates = bool(spec.coordinates) and all(b.column in cols for b in spec.coordinates)

    def q99(c: str):
        return F.percentile_approx(c, 0.99, accuracy).cast("double")

    rows = F.count(F.lit(1))
    out = (
        df.withWatermark("__ts", watermark)
        .groupBy(F.window("__ts", "7 days", "7 days", "4 days").alias("week"))
        .agg(
            rows.alias("row_count"),
            F.sum(null_cells(cols)).cast("long").alias("missing_total"),
            F.greatest(F.lit(0).cast("long"), rows - F.approx_count_distinct(F.xxhash64(*cols), 0.01)).alias("duplicate_estimate"),
            (F.count_if(F.col(dist) < 0) if dist else F.max(F.lit(0).cast("long"))).alias("negative_trip_distance_count"),
            F.count_if(F.col(spec.target) < 0).alias("negative_target_count"),
            F.count_if(F.col(spec.duration_col).isNull() | (F.col(spec.duration_col) <= 0)).alias("invalid_duration_count"),
            (F.count_if(invalid_coordinates(df, spec)) if has_coordinates else F.max(F.lit(0).cast("long"))).alias("invalid_coordinate_count"),
            (q99(dist) if dist else F.max(F.lit(None).cast("double"))).alias("trip_distance_q99"),
            q99(spec.target).alias("target_q99"),
            q99(spec.duration_col).alias("duration_q99"),
        )
    )
    return out.select(F.to_date("week.start").alias(spec.batch_col), *[c for c in out.columns if c != "week"])


def closed_weeks(stream: DataFrame, spec: TableSpec, watermark: str = "1 day") -> DataFrame:
    """M8: a row for each week that the watermark has passed, for append mode. Its counts equal those of ``quality_profile``.

    Two aggregations follow each other. The first is keyed by (week, whole row), NULL = NULL, and holds how often a row came: state is one entry
    for each distinct row of the weeks still open, spread by the row's hash, so a hot week is no hot task. The second adds up a week's
    rows when the first lets them go. Both drop a week's state as it closes; a row later than that is left out. Rows without an event
    time are in no week."""
    cols = list(stream.columns)
    timed = stream.withColumn("__ts", F.col(spec.event_ts).cast("timestamp")).withWatermark("__ts", watermark)
    week = F.window("__ts", "7 days", "7 days", "4 days").alias("week")
    rows = make_time_features(timed.groupBy(week, *cols).agg(F.count(F.lit(1)).alias("__n")), spec)
    out = rows.groupBy("week").agg(*count_columns(rows, spec, cols + [c for c in spec.generated if c not in cols]))
    return out.select(F.to_date("week.start").alias(spec.batch_col), *[c for c in out.columns if c != "week"])


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_closed_weeks(stream: DataFrame, spec: TableSpec, out: str, checkpoint: str, watermark: str = "1 day"):
    """Append what ``closed_weeks`` gives of all that has landed to Parquet files in ``out``; the finished query. State is kept in RocksDB, on the
    executors' disks, with its changes under ``checkpoint``, so a lost executor's state is rebuilt."""
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    conf.set(STATE_STORE, ROCKSDB)
    try:
        told = closed_weeks(stream, spec, watermark).writeStream.outputMode("append").format("parquet")
        query = told.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        conf.unset(STATE_STORE) if before is None else conf.set(STATE_STORE, before)
    return query
