"""CSV sources: trip files, batch files and files to score, each read by its own header."""

from __future__ import annotations

import csv
import io

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from batchlens.operators.features import nan_as_null, normalize_columns
from batchlens.spec import TableSpec

#: Bytes of a file that are read at a time until its header is whole.
_HEAD = 16 << 10


def text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The data files under a path (a file, a folder with its subfolders, or a pattern), by the cluster's own file systems."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(conf)
    found = []
    for status in fs.globStatus(pattern) or []:
        if status.isFile():
            found.append(status.getPath().toString())
            continue
        base = status.getPath().toString()
        each = fs.listFiles(status.getPath(), True)
        while each.hasNext():
            name = each.next().getPath().toString()
            if not any(part.startswith(("_", ".")) for part in name[len(base) :].split("/")):
                found.append(name)
    return sorted(found)


def first_record(text: str, whole: bool) -> list[str] | None:
    """The names of a CSV's first record; None while it may go on beyond the text. Repeated and empty names get their place."""
    lines = io.StringIO(text.removeprefix("\ufeff"), newline="")
    names = next(csv.reader(lines), [])
    if not whole and lines.tell() >= len(lines.getvalue()):
        return None
    out: list[str] = []
    for k, name in enumerate(names):
        name = name.strip()
        out.append(name if name and name not in out else f"{name or '_c'}{k}")
    return out


def _open(path: str):
    uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
    fs, inner = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
    return fs.open_input_stream(inner)


def _heads(batches):
    """path to path, names of its header; a few KB of each file are read."""
    for pdf in batches:
        names = []
        for path in pdf["path"]:
            got, head, data = None, b"", b"."
            with _open(path) as f:
                while got is None:
                    data = f.read(_HEAD)
                    head += data
                    got = first_record(head.decode("utf-8", "ignore"), not data)
            names.append(got)
        pdf["names"] = names
        yield pdf


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files under a path by the column names that they begin with; empty files have none and are left out."""
    files = csv_files(spark, path)
    if not files:
        return {}
    rows = spark.createDataFrame([(f,) for f in files], "path string").repartition(min(len(files), 64))
    found = rows.mapInPandas(_heads, "path string, names array<string>").collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(found, key=lambda r: r["path"]):
        if r["names"]:
            out.setdefault(tuple(r["names"]), []).append(r["path"])
    return out


def read_csv(spark: SparkSession, path: str, spec: TableSpec, source: str | None = None) -> DataFrame:
    """CSVs as text columns by name, then typed by role: event times zone-free, categories text, all else numbers. Files may differ in
    the order and in the set of their columns: files of one header are read together with a schema of their own, and what a file lacks is
    NULL. What does not parse is NULL (lenient, no row is lost), NaN is NULL, aliases are applied, unknown columns stay text. A path without files, or
    with empty ones only, gives an empty table of the columns that ``spec`` requires. ``source`` names a column for the file's name."""
    out = None
    for names, files in files_by_header(spark, path).items():
        part = spark.read.schema(text_schema(names)).option("header", "true").option("mode", "PERMISSIVE").csv(files)
        if source:
            part = part.withColumn(source, F.col("_metadata.file_name"))
        part = normalize_columns(part, spec)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], text_schema([*dict.fromkeys(spec.required), *([source] if source else [])]))
    return typed(out, spec)


def read_trips(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Trip files."""
    return read_csv(spark, path, spec)


def read_batch_files(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Batch files with the file's name as ``source_batch``."""
    return read_csv(spark, path, spec, "source_batch")


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Text columns cast to the types of their roles, bad values NULL."""
    numbers = {spec.target, *(c for c in spec.raw_features if c not in spec.categorical)} | {b.column for b in spec.coordinates}
    numbers |= {c for c in (spec.distance, spec.passengers) if c}
    out = {}
    for c in df.columns:
        if c in (spec.event_ts, spec.end_ts):
            out[c] = F.trim(F.col(c)).try_cast("timestamp_ntz")
        elif c in numbers:
            out[c] = F.trim(F.col(c)).try_cast(DoubleType())
    return nan_as_null(df.withColumns(out))
