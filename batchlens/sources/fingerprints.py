"""Row fingerprints of all that was seen so far, to find rows that come again in a later batch (U2, A4 without the batch key).

History itself is never read: a new batch is compared with a table that has 16 bytes for every distinct row, bucketed by the
fingerprint. The join reads it bucket by bucket without an exchange, so what is shuffled grows with the new batch only."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.session import kept_table

BUCKETS = 64


def fingerprint(columns: list[str]) -> list[Column]:
    """hi, lo: 128 bits over the columns. Hashing passes over NULLs, so which cells are NULL is hashed too."""
    holes = F.concat(*[F.when(F.isnull(c), "1").otherwise("0") for c in columns])
    return [F.xxhash64(F.lit(seed), holes, *columns).alias(name) for seed, name in ((17, "hi"), (71, "lo"))]


class Fingerprints:
    """The fingerprints under ``root``, which all executors must share. ``buckets`` is fixed when the first rows are added; choose it so that
    a bucket (16 bytes a distinct row) fits a task."""

    def __init__(self, spark: SparkSession, root: str, columns: list[str], buckets: int = BUCKETS):
        self.spark, self.columns, self.buckets = spark, list(columns), buckets
        self.name = f"fingerprints_{hashlib.md5(root.encode()).hexdigest()}"
        place = root.replace("'", "\\'")
        spark.sql(
            f"create table if not exists {self.name} (hi bigint, lo bigint) using parquet clustered by (hi, lo) sorted by (hi, lo) into {buckets} buckets location '{place}'"
        )

    def known(self) -> DataFrame:
        """hi, lo of every distinct row added."""
        return self.spark.table(self.name).distinct()  # by bucket: no exchange

    def _counted(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """One row for each key and fingerprint, however often it occurs: a row that makes up a third of the table is no hot key."""
        return rows.select(*keys, *fingerprint(self.columns)).groupBy(*keys, "hi", "lo").agg(F.count(F.lit(1)).alias("n"))

    def compare(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """keys, row_count, seen_rows (rows that were added before), new_rows (distinct rows that were not)."""
        seen = self.known().withColumn("seen", F.lit(True))
        found = self._counted(rows, keys).join(seen, ["hi", "lo"], "left")
        return found.groupBy(*keys).agg(
            F.sum("n").alias("row_count"),
            F.sum(F.when(F.col("seen"), F.col("n")).otherwise(F.lit(0).cast("long"))).alias("seen_rows"),
            F.count_if(F.col("seen").isNull()).alias("new_rows"),
        )

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows that were not added before, all columns as they were."""
        hi, lo = fingerprint(self.columns)
        return rows.withColumns({"__hi": hi, "__lo": lo}).join(
            self.known().select(F.col("hi").alias("__hi"), F.col("lo").alias("__lo")), ["__hi", "__lo"], "left_anti"
        ).drop("__hi", "__lo")

    def add(self, rows: DataFrame) -> None:
        """Append the fingerprints that the table lacks, one file a bucket. Adding rows again adds nothing, so a replay is harmless."""
        fresh = self._counted(rows, []).select("hi", "lo").join(self.known(), ["hi", "lo"], "left_anti")
        kept_table(fresh, "fingerprints").repartition(self.buckets, "hi", "lo").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
