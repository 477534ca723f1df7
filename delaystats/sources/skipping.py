"""File skipping for keyed layouts whose key has many values.

A directory per key value would mean millions of small files.  Instead the
layout is cut into files of consecutive keys, and an index keeps for every file
the least and the greatest value of each key column and a Bloom bitmap of its
keys.  A lookup of keys joins them with the index first and opens only the
files that can hold one.  The index is a table, built and asked by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystats.operators.upsert import upsert
from delaystats.schema import KeyedLayout
from delaystats.sources.layout import TASK_ROWS, write_partitioned

#: Bits of a file's bitmap: a false hit in some 1 of 13 for 20 000 keys a file.
BITS = 1 << 18
PIECE = 1 << 15         # bits of one of Spark's bitmap values


def write_cut(df: DataFrame, path: str, table: KeyedLayout, files: int, mode: str = "overwrite",
              seq: Sequence[str] | None = None) -> str:
    """Write ``df`` as ``table`` in about ``files`` files of consecutive keys,
    more where these would hold more than TASK_ROWS rows.

    With ``seq`` only the last written row of each key: rows are dealt in
    ranges of the primary key, which the upsert needs as well as the files.
    """
    files = max(files, -(-df.count() // TASK_ROWS))
    if seq is not None:
        latest = upsert(df.repartitionByRange(files, *table.primary_key), table.primary_key, seq)
        return write_partitioned(latest, path, partition_by=table.partition, cluster_by=table.clustering, mode=mode,
                                 dealt=True)
    return write_partitioned(df, path, partition_by=table.partition, cluster_by=table.clustering, mode=mode,
                             num_partitions=files)


def _bit(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in key]), F.lit(BITS))


def build_index(spark: SparkSession, path: str, partition: Sequence[str], key: Sequence[str], index_path: str,
                schema: T.StructType) -> str:
    """Index the files below ``path`` by the columns ``key`` (one scan of
    them): per file and piece of its bitmap the partition values, the least
    and the greatest key values, and the bits of the piece."""
    rows = spark.read.schema(schema).parquet(path).select(
        F.col("_metadata.file_path").alias("file"), *key, _bit(key).alias("bit"))
    pieces = rows.groupBy("file", F.floor(F.col("bit") / PIECE).cast("int").alias("piece")).agg(
        *[F.first(c).alias(c) for c in partition],
        *[f(c).alias(f"{name}_{c}") for c in key for f, name in ((F.min, "least"), (F.max, "greatest"))],
        F.bitmap_construct_agg(F.pmod("bit", F.lit(PIECE))).alias("bits"))
    pieces.write.mode("overwrite").parquet(index_path)
    return index_path


def files_with(spark: SparkSession, index_path: str, partition: Sequence[str], key: Sequence[str],
               keys: DataFrame) -> list[str]:
    """The files that can hold a row of ``keys``.  A piece belongs to one
    partition, so a key meets only the files of its own."""
    index = spark.read.parquet(index_path)
    wanted = keys.select(*key, _bit(key).alias("bit")).withColumn("piece", F.floor(F.col("bit") / PIECE).cast("int"))
    wanted = wanted.withColumnsRenamed({c: f"want_{c}" for c in key})
    same = [F.col(c) == F.col(f"want_{c}") for c in partition if c in key]
    hit = index.join(F.broadcast(wanted.withColumnRenamed("piece", "want_piece")),
                     (F.col("piece") == F.col("want_piece")) & _all(same))
    within = [F.col(f"want_{c}").between(F.col(f"least_{c}"), F.col(f"greatest_{c}")) for c in key]
    place = F.pmod("bit", F.lit(PIECE))
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))).cast("int") % 2 == 1
    return [r["file"] for r in hit.where(_all(within) & set_).select("file").distinct().collect()]


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def lookup(spark: SparkSession, path: str, index_path: str, partition: Sequence[str], key: Sequence[str],
           keys: list[tuple], schema: T.StructType) -> DataFrame:
    """The rows whose ``key`` columns equal one of ``keys`` (a caller's list;
    a null in a key equals nothing).  Other files are not opened."""
    types = T.StructType([schema[c] for c in key])
    wanted = spark.createDataFrame(sorted(set(keys)), types)
    files = files_with(spark, index_path, partition, key, wanted)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*files)
    return rows.join(F.broadcast(wanted), list(key), "left_semi").select(*schema.fieldNames())
