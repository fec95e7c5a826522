"""Tables under one store root (a shared folder): batches, their index, logs, ledger, registry, models, outputs.

Batch rows lie in ``batches/epoch=<n>/batch_id=<id>/``; the batch index has a row for each epoch and batch, so which batches there are,
how many rows they hold and which are pending is known without looking at the rows. Logs are append-only Parquet tables read with schema merging:
records may add columns. A missing table reads as empty with its known schema. Log rows belong to a run and count
only once the ledger has that run (``committed_log``). A batch is committed by one run only (``commit_batch``).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from batchlens.operators.batching import with_names
from batchlens.spec import TableSpec

BATCHES = "batches"
BATCH_INDEX = "batch_index"
BATCH_META = "batch_meta"
QUALITY = "quality_log"
TRAINING = "training_log"
UPDATES = "update_log"
REGISTRY = "registry"
LEDGER = "ledger"
RULES = "rules"
RULES_CONFIG = "rules_config"
TOP_RULES = "top_rules"
PREDICTIONS = "predictions"
INFERENCE = "inference_metrics"
MODELS = "models"
CLAIMS = "claims"

# The field names of the logs' records.
SCHEMAS = {
    LEDGER: (
        "batch_id string, batch_start timestamp_ntz, batch_name string, upto_epoch long, run_id string, kind string, status string, "
        "processed_at timestamp"
    ),
    REGISTRY: (
        "model_key string, model_name string, model_type string, version string, path string, params string, "
        "val_rmse double, val_mae double, val_r2 double, test_rmse double, test_mae double, test_r2 double, "
        "batch_rmse double, batch_mae double, batch_r2 double, train_rows long, test_rows long, "
        "train_batches long, test_batch string, update_strategy string, is_best boolean, run_id string, "
        "created_at timestamp, ordinal long, features string, numerical string, categorical string, preprocessing string, "
        "selection_strategy string, batch_rows long"
    ),
    QUALITY: (
        "batch_start timestamp_ntz, batch_name string, row_count long, missing_total long, duplicate_count long, "
        "negative_trip_distance_count long, negative_target_count long, invalid_duration_count long, "
        "invalid_coordinate_count long, trip_distance_q99 double, target_q99 double, duration_q99 double, "
        "run_id string, created_at timestamp"
    ),
    TRAINING: (
        "created_at timestamp, model_name string, model_key string, train_rows long, test_rows long, "
        "train_batches long, test_batch string, selection_strategy string, val_mae double, val_rmse double, "
        "val_r2 double, test_mae double, test_rmse double, test_r2 double, is_best boolean, model_version string, "
        "run_id string"
    ),
    UPDATES: (
        "created_at timestamp, processed_batch_index long, processed_batch_name string, "
        "available_batches_after_update long, quality_row_count long, quality_missing_total long, "
        "quality_duplicate_count long, quality_negative_target_count long, quality_invalid_duration_count long, "
        "quality_invalid_coordinate_count long, incremental_update_attempted boolean, "
        "updated_candidate_models long, pre_update_model_name string, pre_update_model_key string, "
        "pre_update_batch_rows long, pre_update_mae double, pre_update_rmse double, pre_update_r2 double, "
        "post_update_model_name string, post_update_model_key string, post_update_model_type string, "
        "post_update_strategy string, post_update_batch_rows long, post_update_model_version string, "
        "post_update_batch_mae double, post_update_batch_rmse double, post_update_batch_r2 double, "
        "update_error string, run_id string"
    ),
}


def new_run_id() -> str:
    return dt.datetime.now().strftime("%Y%m%d_%H%M%S_") + uuid.uuid4().hex[:8]


def now() -> dt.datetime:
    return dt.datetime.now()


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = hp.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(hp)

    def read(self, name: str) -> DataFrame:
        """The table, or an empty frame with its known schema when it does not exist yet."""
        if self.exists(name):
            return self.spark.read.option("mergeSchema", "true").parquet(self.path(name))
        schema = SCHEMAS.get(name)
        if schema is None:
            return self.spark.createDataFrame([], StructType([]))
        return self.spark.createDataFrame([], schema)

    def append(self, name: str, df: DataFrame) -> None:
        """Append records (new columns allowed)."""
        df.write.mode("append").parquet(self.path(name))

    def committed_log(self, name: str) -> DataFrame:
        """The rows of runs that the ledger has; what a crashed run left behind is not seen."""
        return self.read(name).join(self.read(LEDGER).select("run_id").distinct(), "run_id", "left_semi")

    def append_rows(self, name: str, rows: list[dict]) -> None:
        """Append records; fields the known schema lacks become columns of their own."""
        if not rows:
            return
        st = self.spark.createDataFrame([], SCHEMAS[name]).schema if name in SCHEMAS else StructType([])
        known = {f.name for f in st.fields}
        for k in sorted({k for r in rows for k in r} - known):
            sample = next((r[k] for r in rows if r.get(k) is not None), None)
            st = st.add(k, _TYPES.get(type(sample), "string"))
        self.append(name, self.spark.createDataFrame([tuple(_value(r.get(f.name), f.dataType.typeName()) for f in st.fields) for r in rows], st))

    # ---- single winners ----

    def put_if_absent(self, name: str, text: str) -> bool:
        """Write a small file under a name that nobody has taken; False if it is there already. The file appears whole: it is written beside and
        then given its name, by a link on local folders and by a rename that does not replace elsewhere, so of two writers one wins."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(self.path(name))
        beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
        fs = target.getFileSystem(conf)
        out = fs.create(beside)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":
                try:
                    os.link(beside.toUri().getPath(), target.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            if fs.exists(target):
                return False
            try:
                none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                renames = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                renames[0] = none
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(beside, target, renames)
            except Exception:
                if fs.exists(target):
                    return False
                raise
            return True
        finally:
            fs.delete(beside, False)

    def text_of(self, name: str) -> str:
        """A small file's text."""
        return "\n".join(r["value"] for r in self.spark.read.text(self.path(name)).collect())

    def commit_batch(self, row: dict) -> bool:
        """Put an update's ledger row down, if no other update of the same batch and epoch has claimed it."""
        won = self.put_if_absent(_claim(row["batch_id"], row["upto_epoch"]), json.dumps(row, default=str))
        if won:
            self.append_rows(LEDGER, [row])
        return won

    def complete_claim(self, batch: str, epoch: int) -> str | None:
        """The run that claimed a batch and died before the ledger had it: the claim holds the whole row, which is put there now."""
        name = _claim(batch, epoch)
        if not self.exists(name):
            return None
        row = json.loads(self.text_of(name))
        if not self.read(LEDGER).where(F.col("run_id") == row["run_id"]).isEmpty():
            return None
        row |= {k: dt.datetime.fromisoformat(row[k]) for k in ("batch_start", "processed_at") if row.get(k)}
        self.append_rows(LEDGER, [row])
        return row["run_id"]

    # ---- batches ----

    def write_batches(self, batched: DataFrame, spec: TableSpec, epoch: int = 0) -> None:
        """One folder per epoch and batch; rows sorted by event time inside each task's file. Writing an epoch again replaces
        it, so a replayed micro-batch changes nothing.

        No shuffle by the batch key (a hot batch would land in one task): every task writes its own share of each batch."""
        rows = batched.withColumns({"epoch": F.lit(epoch).cast("long"), "batch_id": batch_id(spec.batch_col)})
        self._put(rows.sortWithinPartitions("batch_id", spec.event_ts), BATCHES, "epoch", "batch_id")
        own = self.spark.read.schema(rows.schema).parquet(self.path(BATCHES)).where(F.col("epoch") == epoch)
        index = own.groupBy("epoch", "batch_id", spec.batch_col).agg(
            F.count(F.lit(1)).alias("row_count"), F.min(spec.event_ts).alias("pickup_min"), F.max(spec.event_ts).alias("pickup_max")
        )
        self._put(index.coalesce(1), BATCH_INDEX, "epoch")

    def _put(self, df: DataFrame, name: str, *by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(self.path(name))

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path(BATCHES))

    def batches(self) -> DataFrame:
        """The rows of all batches."""
        return self._rows().drop("epoch", "batch_id")

    def batch_table(self, spec: TableSpec) -> DataFrame:
        """W1 from the index: batch_id, key, batch_index, batch_name, row_count, pickup_min, pickup_max, upto_epoch."""
        per = self.spark.read.parquet(self.path(BATCH_INDEX)).groupBy("batch_id", spec.batch_col).agg(
            F.sum("row_count").alias("row_count"), F.min("pickup_min").alias("pickup_min"), F.max("pickup_max").alias("pickup_max"),
            F.max("epoch").cast("long").alias("upto_epoch"),
        )
        return with_names(per.where(F.col("row_count") >= self.least_rows(spec)), spec)

    def least_rows(self, spec: TableSpec) -> int:
        return 1  # only batches of full size are written

    def batch_rows(self, batch: str, after_epoch: int | None = None) -> DataFrame:
        """The rows of one batch, or those that came after an epoch; both are partition predicates."""
        rows = self._rows().where(F.col("batch_id") == batch)
        if after_epoch is not None:
            rows = rows.where(F.col("epoch") > after_epoch)
        return rows.drop("epoch", "batch_id")

    def done(self) -> DataFrame:
        """(batch_id, done_epoch) of the batches the ledger has."""
        ledger = self.read(LEDGER).where(F.col("batch_id").isNotNull())
        return ledger.groupBy("batch_id").agg(F.max("upto_epoch").alias("done_epoch"))

    def pending(self, spec: TableSpec) -> DataFrame:
        """batches that are not in the ledger, or have rows of a later epoch than it knows (``done_epoch``)."""
        return pending_batches(self.batch_table(spec), self.done())

    def model_path(self, key: str, version: str) -> str:
        return self.path(MODELS, key, version)


_TYPES = {bool: "boolean", int: "long", float: "double", dt.datetime: "timestamp", dt.date: "date"}


def _claim(batch: str, epoch: int) -> str:
    return f"{CLAIMS}/{batch}/{epoch}"


def _value(v, kind: str):
    if kind == "timestamp_ntz" and isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    return str(v) if kind == "string" and v is not None else v


def batch_id(key: str) -> Column:
    """Text id of a batch from its key, the same for dates and hours; the letter keeps folder names from being read as dates."""
    return F.concat(F.lit("b"), F.date_format(F.col(key).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH"))


def pending_batches(table: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of a batch table (batch_id, upto_epoch) that the ledger lacks or knows only in part, with ``done_epoch``."""
    rows = table.join(done, "batch_id", "left")
    return rows.where(F.col("done_epoch").isNull() | (F.col("upto_epoch") > F.col("done_epoch")))


def latest_per(df: DataFrame, key: str, order: str) -> DataFrame:
    """Newest row per key (``max_by`` on a struct: one partial aggregate, no window sort)."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("r")).select("r.*")
