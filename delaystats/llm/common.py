"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystats.session import lowered, scratch_path

#: Bytes of rows that go to a Python worker at a time while a table is written:
#: both sides hold a batch several times over, one for each step of a task.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Columns of one input table."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame, what: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: the
    lineage is cut, and every consumer sees the same rows.

    The shuffle files of the plan that made it are of no use any more.  Spark
    removes them once the driver's handles to them are collected, which an idle
    driver does not do by itself, so it is asked to.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", what)
    with lowered(spark, BATCH):
        df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    spark.sparkContext._jvm.System.gc()
    return out


def release(spark: SparkSession) -> None:
    """Let go of what earlier steps left in the driver: models and collected
    samples in Python, plans and shuffle handles in the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def lean(fn: Callable) -> Callable:
    """The Arrow pass ``fn``, which at its end gives back what it took: Spark
    keeps the worker for other steps, idle ones too, and what its allocators hold
    counts against the executor all that time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc
        if trim:
            trim(0)
    return run


def forget(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_names(df: DataFrame, n: int, taken: Sequence[str] = ()) -> list[str]:
    """Column names that neither ``df`` nor ``taken`` has, in any case."""
    stem = "_own"
    while any(c.lower().startswith(stem) for c in [*df.columns, *taken]):
        stem += "_"
    return [f"{stem}{i}" for i in range(n)]


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def hash_sample(df: DataFrame, id_col: str, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` rows, the ones with the smallest salted hash of the id
    (a uniform sample that does not depend on partitioning or order)."""
    return (df.withColumn("_h", F.xxhash64(F.lit(seed), F.col(id_col)))
            .orderBy("_h", id_col).limit(rows).drop("_h"))


def threshold_sample(df: DataFrame, id_col: str, rows: int, seed: int, where: Column | None = None) -> DataFrame:
    """At most ``rows`` distinct ids of ``df`` that fulfil ``where``: the ones
    with the smallest salted hash.

    Ids are first cut by a threshold on the hash that some 2 x ``rows`` of them
    pass, so that ``where`` (a scan of texts, say) sees few rows and no task
    gets more than a small multiple of the sample.  Where too few fulfil it, the
    threshold is raised and the scan repeated.  A null id is never taken.
    """
    ids = df.where(F.col(id_col).isNotNull())
    digest = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30))
    share = min(1.0, 2 * rows / max(ids.select(id_col).count(), 1))
    while True:
        part = ids.where(digest <= int(share * (1 << 30)))
        part = part.where(where) if where is not None else part
        got = written(part.select(id_col).distinct(), "sample")
        if share >= 1 or got.count() >= rows:
            return (got.withColumn("_h", F.xxhash64(F.lit(seed), F.col(id_col)))
                    .orderBy(digest, "_h", id_col).limit(rows).drop("_h"))
        share = min(1.0, 8 * share)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process, so that tasks
    run by the same worker share it."""
    import sys
    import types

    module = sys.modules.setdefault("_delaystats_worker_cache", types.ModuleType("_delaystats_worker_cache"))
    return module.__dict__.setdefault(name, {})
