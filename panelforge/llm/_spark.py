"""Session-side helpers of the operators: shared checkpoints, batch size, bounded broadcasts."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a table that may be sent to every executor; above it the same join shuffles.
BROADCAST_BYTES = 64 << 20
#: Rows of an Arrow batch: a few MB at usual text lengths.
BATCH_ROWS = 500


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.  Where it is unset: a temporary one in local mode, an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        at = tempfile.mkdtemp(prefix="panelforge-")
        atexit.register(shutil.rmtree, at, True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def cut(df: DataFrame, what: str = "part") -> DataFrame:
    """``df`` written as a table in the shared folder and read again: lineage ends there.

    The files survive lost executors, and what follows sees one fixed version
    of the rows even if the input would not be read alike twice.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/panelforge/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._part = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes tables that ``cut`` wrote; for when everything that reads them is written."""
    for f in frames:
        remove(f.sparkSession, f._part)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def trimmed(batches_function):
    """A function over Arrow batches after which the worker, which Spark keeps, gives freed memory back to the system."""

    @functools.wraps(batches_function)
    def run(batches):
        try:
            yield from batches_function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch, so that batches of long texts fit a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def fitting(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows fit the bound, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows numbered by one task, about.
CHUNK_ROWS = 50_000


def numbered(df: DataFrame, keys: list[str], spread: list[str], order: list[str], rows: int, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... without gaps inside each value of ``keys``.

    A key's rows are dealt to hashed chunks, numbered inside each chunk and
    moved up by the sizes of the chunks before, so a key that holds most rows
    is numbered by many tasks.  ``df`` is evaluated twice: give a cut table.
    """
    from pyspark.sql import Window

    chunk = F.pmod(F.xxhash64(*spread), F.lit(max(1, rows // CHUNK_ROWS))).alias("_chunk")
    dealt = df.select("*", chunk)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n")).select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return dealt.join(offsets, [*keys, "_chunk"]).select(*df.columns, (F.row_number().over(within) - 1 + F.col("_before")).cast("long").alias(name))
