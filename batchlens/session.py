"""Session helpers: defaults for local runs, the shared checkpoint folder, shipping the package to executors."""

from __future__ import annotations

import logging
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "batchlens") -> SparkSession:
    """Session for tests and the bench. A cluster job uses its own session; nothing here assumes local mode."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset (tests, the bench)
    create a folder of our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="batchlens-ckpt-")
        log.warning("spark.checkpoint.dir unset; using %s (local runs only)", conf)
        spark.conf.set(CHECKPOINT_CONF, conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def kept_table(df: DataFrame, what: str) -> DataFrame:
    """A small table written to the shared folder and read back, so that Spark knows its size when it plans joins."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, which need not have it installed or start in its folder. Once a Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="batchlens-zip-"), "batchlens.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss; never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
