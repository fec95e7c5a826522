"""Helpers shared by the operators: stored intermediates, fixed-size Bloom filters, deterministic range
shards, and files on the shared store."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.session import ensure_checkpoint_dir

#: Bits of a Bloom filter: 2 MB, whatever is put into it. A full filter only stops filtering; it loses nothing.
BLOOM_BITS = 1 << 24
_PAGE = 32768  # bits in one row of bitmap_construct_agg


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write to a Parquet table in the shared folder and read it back: lineage ends there, and lost
    executors cost nothing that has been stored."""
    path = fresh_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch that goes to a worker. Spark's own bound is 256 MB and 10,000 rows, tens of MB of whole texts, held several times by
#: executor and worker alike.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to the workers in batches of about BATCH_BYTES, one row at least, unless the session has a bound of its own. A setting of the
    session, as a returned DataFrame runs later."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- Bloom filters


def bloom(df: DataFrame, key: Column) -> bytes:
    """Bloom filter (two bits a key) of a long column, built by aggregation: at most 512 rows of 4 KB come to
    the driver, whatever the input."""
    k = df.select(key.alias("k"))
    pos = k.select(F.explode(F.array(F.pmod("k", F.lit(BLOOM_BITS)), F.pmod(F.shiftrightunsigned("k", 32), F.lit(BLOOM_BITS)))).alias("p"))
    rows = (
        pos.groupBy(F.floor(F.col("p") / _PAGE).cast("int").alias("page"))
        .agg(F.bitmap_construct_agg((F.col("p") % _PAGE)).alias("bits"))
        .collect()
    )
    out = np.zeros((BLOOM_BITS // _PAGE, _PAGE // 8), np.uint8)
    for r in rows:
        if r["page"] is not None:
            out[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def bloom_mask(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the uint64 keys may be in the filter."""
    a = h & np.uint64(BLOOM_BITS - 1)
    hit = np.flatnonzero((bits[(a >> np.uint64(3)).astype(np.int64)] >> (a & np.uint64(7)).astype(np.uint8)) & 1)
    b = (h[hit] >> np.uint64(32)) & np.uint64(BLOOM_BITS - 1)
    hit = hit[((bits[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)]
    mask = np.zeros(len(h), bool)
    mask[hit] = True
    return mask


# ---------------------------------------------------------------- range shards

#: Bits of a key that the first weighing tells apart, and that every further weighing of a heavy cell does.
GRID_BITS = 12
CELL_BITS = 6
#: Bits of a tie.
TIE_BITS = 31


def _right(c: Column, bits) -> Column:
    return F.call_function("shiftright", c, bits if isinstance(bits, Column) else F.lit(bits))


def range_shards(df: DataFrame, key: str, weight: Column, target: int, tie: Column) -> tuple[Column, int]:
    """A shard number that rises with ``key`` (a long) and then ``tie`` (0 to 2 ** TIE_BITS - 1, evenly spread), and the number of
    shards. Deterministic: it depends on the data only, not on partitions or sampling. Cells of keys that agree on their leading
    bits are weighed (at most 4096 rows to the driver), cells heavier than ``target`` again by their next bits (64 rows a heavy cell)
    until none but single keys are heavier; cells are then put together up to ``target``. A heavier single key, or the rows
    without one, which sort first, are divided by ``tie``. Rows of one key and tie always share a shard."""
    weights = stored(df.groupBy(F.col(key).alias("key")).agg(F.coalesce(F.sum(weight), F.lit(0)).cast("long").alias("w")), "weights")
    lo, hi, nulls = weights.agg(F.min("key"), F.max("key"), F.sum(F.when(F.col("key").isNull(), F.col("w")))).first()
    parts: dict[int, int] = {}  # shards that follow the first of a key that is divided
    n, room = 0, 0

    def put(w: int) -> int:
        """The shard of the next cell."""
        nonlocal n, room
        if w > target:
            n += room > 0
            first, room = n, 0
            parts[first] = -(-w // target)
            n += parts[first]
            return first
        if room and room + w > target:
            n, room = n + 1, 0
        room += w
        return n

    put(int(nulls or 0))
    place = F.lit(0).cast("long")
    if lo is not None:
        shifts = [max(0, ((lo ^ hi) & (1 << 64) - 1).bit_length() - GRID_BITS)]
        levels = []  # of each weighing: prefix to weight, and the heavy prefixes
        held = weights.where(F.col("key").isNotNull())
        while True:
            s = shifts[-1]
            found = {r["p"]: r["w"] for r in held.groupBy(_right(F.col("key"), s).alias("p")).agg(F.sum("w").alias("w")).collect()}
            heavy = sorted(p for p, w in found.items() if w > target) if s else []
            levels.append((found, set(heavy)))
            if not heavy:
                break
            wanted = df.sparkSession.createDataFrame([(p,) for p in heavy], "p long")
            held = weights.join(wanted, _right(F.col("key"), s) == F.col("p"), "left_semi")
            shifts.append(max(0, s - CELL_BITS))
        base = lo >> shifts[0]
        cells = [0] * ((hi >> shifts[0]) - base + 1)

        def fill(at: int, p: int, level: int):
            """cells[at] for a prefix: its shard, or minus the place (from 1) where the next bits' cells begin."""
            found, heavy = levels[level]
            if p not in heavy:
                cells[at] = put(found.get(p, 0))
                return
            bits, start = shifts[level] - shifts[level + 1], len(cells)
            cells[at] = -start - 1
            cells.extend([0] * (1 << bits))
            for k in range(1 << bits):
                fill(start + k, (p << bits) | k, level + 1)

        for k in range(len(cells)):
            fill(k, base + k, 0)
        table_of = F.lit(np.array(cells, np.int64))
        place = F.element_at(table_of, (_right(F.col(key), shifts[0]) - base + 1).cast("int"))
        if len(shifts) > 1:
            steps = F.array(*[F.struct(F.lit(s).alias("s"), F.lit((1 << before - s) - 1).cast("long").alias("mask")) for before, s in zip(shifts, shifts[1:])])

            def deeper(c, step):
                at = _right(F.col(key), step["s"]).bitwiseAND(step["mask"]) - c
                return F.when(c < 0, F.element_at(table_of, at.cast("int"))).otherwise(c)

            place = F.aggregate(steps, place, deeper)
        place = F.coalesce(place, F.lit(0).cast("long"))
    total = max(1, n + (room > 0))
    if parts:
        divided = F.lit(np.array([parts.get(k, 1) for k in range(total + 1)], np.int64))
        place = place + _right(tie.cast("long") * F.element_at(divided, (place + 1).cast("int")), TIE_BITS)
    return place.cast("int"), total


# ---------------------------------------------------------------- files on the shared store


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system and the path in it, for a folder of the shared store (file:, hdfs:, s3:, ...)."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def commit_files(manifest: DataFrame, root: str) -> DataFrame:
    """Give the files of a stored manifest (columns temp, name) their final names. The manifest holds one
    attempt of each shard; renaming is idempotent, so a lost task may run again."""

    def rename(batches):
        fs, base = file_system(root)
        for b in batches:
            for temp, name in zip(b.column("temp").to_pylist(), b.column("name").to_pylist()):
                if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
                    try:
                        fs.move(f"{base}/{temp}", f"{base}/{name}")
                    except OSError:  # another attempt of this task was faster
                        if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
                            raise
            yield b

    return stored(manifest.mapInArrow(rename, manifest.schema), "manifest")
