"""Incremental load: CSV files arriving in a folder -> the keyed layout.

The reference loads by streaming rows from files into the store in groups
(a wait per group of 50 000 rows), each INSERT upserting its key.  The
Structured Streaming form: a file source with a fixed schema, one
micro-batch per ``max_files_per_trigger`` new files, and a ``foreachBatch``
sink that converts, splits rejects and writes the batch into the layout.

Exactly once: each batch writes into its own ``batch_id=<n>`` folder with
``overwrite``, so a batch replayed after a failure replaces its own output
instead of adding to it; the checkpoint records which files were consumed.
Last write wins is applied on read (:func:`read_upserted`), ordered by
``batch_id`` and then the caller's sequence columns: merge on read, since
plain Parquet has no MERGE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from delaystats.operators.ingest import CORRUPT, classify
from delaystats.operators.upsert import upsert
from delaystats.schema import COLUMNS, all_string_schema
from delaystats.sources.layout import write_partitioned

BATCH = "batch_id"


def read_csv_stream(spark: SparkSession, source_dir: str, extra: T.StructType | None = None,
                    max_files_per_trigger: int = 1) -> DataFrame:
    schema = all_string_schema(extra).add(T.StructField(CORRUPT, T.StringType(), True))
    df = (spark.readStream.schema(schema)
          .option("header", True)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT)
          .option("escape", '"')
          .option("maxFilesPerTrigger", max_files_per_trigger)
          .csv(source_dir))
    text = set(COLUMNS)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in text else F.col(c)
                       for c in df.columns])


def _writer(table_path: str, rejects_path: str, variant: str, layout_options: dict):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            c = classify(batch, variant)
            good = c.good
            if variant == "v5":
                from delaystats.functions import parse_date
                good = good.withColumn("flightdate", parse_date("year", "month", "day"))
            write_partitioned(good, f"{table_path}/{BATCH}={batch_id}", mode="overwrite",
                              **layout_options)
            (c.rejects.write.mode("overwrite")
             .parquet(f"{rejects_path}/{BATCH}={batch_id}"))
        finally:
            batch.unpersist()
    return write_batch


def start_stream_load(spark: SparkSession, source_dir: str, table_path: str, rejects_path: str,
                      checkpoint: str, variant: str = "v5", extra: T.StructType | None = None,
                      max_files_per_trigger: int = 1, available_now: bool = True,
                      **layout_options) -> StreamingQuery:
    """Start the incremental load; with ``available_now`` it stops by itself
    once every file present at start has been loaded."""
    stream = read_csv_stream(spark, source_dir, extra, max_files_per_trigger)
    writer = (stream.writeStream
              .foreachBatch(_writer(table_path, rejects_path, variant, layout_options))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_loaded(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """All loaded rows (every batch), with their ``batch_id``."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType(), True)])
    return spark.read.schema(full).parquet(table_path)


def read_upserted(spark: SparkSession, table_path: str, schema: T.StructType,
                  key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per key: the one written last (latest batch, then ``seq``)."""
    return upsert(read_loaded(spark, table_path, schema), key, [BATCH, *seq]).drop(BATCH)
