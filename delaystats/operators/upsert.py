"""Keyed upsert: one row per primary key, the last write wins.

A key-value store overwrites an equal key on INSERT.  The write order must be
an explicit total order (``seq``); ``dropDuplicates`` would keep an arbitrary
row.  ``row_number() = 1`` per key plans as ``WindowGroupLimit`` partial +
final: each task keeps only its latest row per key before the shuffle, so a
key written a billion times costs one row per task, not one hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystats.schema import KeyedLayout


def upsert(df: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in seq])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def merge_into(path: str, table: KeyedLayout, batch: DataFrame, seq: Sequence[str], schema: T.StructType) -> int:
    """Apply a batch of writes to the keyed table at ``path`` (both carry
    ``seq``; ``schema`` is the table's); returns the directories touched.

    Only the directories of the batch's partition keys are read and rewritten,
    at most as many keys as the driver lists directories.  Spark stages their
    new files and moves them in when all are written; all other files stay as
    they are.  A null part of a key equals a null.  ``batch`` is evaluated
    twice and must give the same rows.
    """
    from delaystats.sources.layout import read_layout, write_partitioned

    place = F.to_json(F.struct(*table.partition))
    rows = batch.select(*schema.fieldNames())
    touched = [r[0] for r in rows.select(place.alias("place")).distinct().collect()]
    if not touched:
        return 0
    stored = read_layout(batch.sparkSession, path, schema).where(place.isin(touched))    # a partition filter
    latest = upsert(stored.unionByName(rows), table.primary_key, seq)
    write_partitioned(latest, path, partition_by=table.partition, cluster_by=table.clustering, mode="overwrite",
                      dynamic=True)
    return len(touched)
