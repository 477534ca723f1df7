"""Keyed-table layouts on Parquet.

The reference stores rows in a key-value store keyed by a partition key and
clustering columns.  Here a keyed table is a Parquet directory:

* ``write_partitioned``: directories per partition-key value (default
  ``year/month``: one directory per month keeps files large at any scale),
  rows sorted by the clustering columns inside each file so that row-group
  statistics prune on them.  Rows are rebalanced on the partition key first
  (AQE splits an oversized directory across tasks), so each task writes few
  directories: no tasks x keys file explosion, no single-task hot month.
* ``write_bucketed``: hash buckets on a high-cardinality key, sorted inside;
  a later ``groupBy``/join on the bucket column needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystats.schema import KeyedLayout
from delaystats.session import scratch_path, write_settings

TASK_ROWS = 500_000     # wide rows that one task sorts in memory
SLICE = "_slice"
PIECES = 64             # pieces of a partition in which its rows are counted
STEPS = 8               # parts in which a big table is written, one after the other,
STEP_ROWS = 4_000_000   # each of so many wide rows at least


def _aqe_on(spark: SparkSession) -> bool:
    return str(spark.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true"


def samples_input(spark: SparkSession, num_partitions: int | None = None) -> bool:
    """Whether ``write_partitioned`` will run a range-sampling pass over its
    input (metrics observed below its exchange would then count twice)."""
    return bool(num_partitions) or not _aqe_on(spark)


def write_partitioned(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("year", "month"),
                      cluster_by: tuple[str, ...] = ("uniquecarrier", "flightnum", "day"),
                      max_records_per_file: int | None = None, mode: str = "append",
                      num_partitions: int | None = None,
                      observation: Observation | None = None,
                      metrics: Sequence[Column] = (), dynamic: bool = False, dealt: bool = False) -> str:
    """Write ``df`` as a keyed layout: ``partitionBy`` directories, files
    sorted by the clustering columns.

    With AQE on, rows are *rebalanced* on the partition key: one shuffle, no
    sampling pass over the input, tasks get whole directories (one file per
    directory and task), and AQE splits a directory that is too big for one
    task (a month holding a third of the data) by map-output size.  Without
    AQE, or with an explicit ``num_partitions``, the rows are range-partitioned
    on the full (partition + clustering) key instead: balanced by sampling,
    at the price of a sampling pass over the input.

    ``max_records_per_file`` caps rows per file (``LOAD_BATCH_ROWS`` gives
    the reference's load groups).  Off by default: at scale a 50 000-row cap
    would mean millions of ~1 MB files; without it, file size follows the
    rebalance's advisory partition size (``spark.sql.adaptive.
    advisoryPartitionSizeInBytes``).

    ``observation`` (if given) counts the written rows, or takes ``metrics``.
    It is attached *after* the exchange: a range sampler runs the plan below
    the exchange as an extra job, and metrics collected there would count twice.

    ``dynamic`` makes an overwrite replace only the directories it writes to;
    Spark stages the new files and moves them when all tasks are done.
    ``dealt`` rows are written by the tasks they are in, without an exchange.
    """
    spark = df.sparkSession
    key = [*partition_by, *cluster_by]
    if dealt:
        spread = df
    elif num_partitions is None and _aqe_on(spark):
        spread = df.hint("rebalance", *partition_by)
    elif num_partitions:
        spread = df.repartitionByRange(num_partitions, *key)
    else:
        spread = df.repartitionByRange(*key)
    if observation is not None:
        spread = spread.observe(observation, *(metrics or [F.count(F.lit(1)).alias("rows")]))
    writer = spread.sortWithinPartitions(*key).write.mode(mode).partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with write_settings(spark):
        writer.parquet(path)
    return path


def in_steps(df: DataFrame, by: Sequence[str], at_most: int | None = None) -> list[DataFrame]:
    """``df`` cut into frames that share no value of ``by`` (bounded like
    partition keys), about STEPS of a big table, none below STEP_ROWS rows but
    the last.  Written one after the other, only one has shuffle files on disk.
    ``df`` must give the same rows each time it is evaluated; rows are not
    counted if it is known to have few ``at_most``."""
    if at_most is not None and at_most <= STEP_ROWS:
        return [df]
    place = F.hash(*by)
    sizes = df.groupBy(place.alias("at")).count().orderBy("at").collect()
    full = max(STEP_ROWS, -(-sum(r["count"] for r in sizes) // STEPS))
    steps, rows = [[]], 0
    for r in sizes:
        if rows >= full:
            steps.append([])
            rows = 0
        steps[-1].append(r["at"])
        rows += r["count"]
    if len(steps) == 1:
        return [df]
    return [*[df.where(place.isin(s)) for s in steps[:-1]], df.where(~place.isin([at for s in steps[:-1] for at in s]))]


def _deal(df: DataFrame, table: KeyedLayout, times: int = 1) -> DataFrame | None:
    """``df`` dealt to tasks so that each has all rows of its primary keys and
    few partition keys: by the partition key and, where a partition has more
    than TASK_ROWS rows, a slice of its clustering keys (``_slice``).  Tasks get
    fewer rows if each is to be written so many ``times``.

    None where keys are written over and over: half of all rows or more are
    older ones, or one piece of a partition has far more than its share of the
    rows.  Rows are counted first, over the key columns alone.
    """
    spark = df.sparkSession
    room = max(1, TASK_ROWS // times)
    digest = F.xxhash64(*table.clustering)
    pieces = df.groupBy(*table.partition, F.pmod(digest, F.lit(PIECES)).alias("_piece")).agg(
        F.count(F.lit(1)).alias("_rows"), F.approx_count_distinct(digest, 0.2).alias("_keys"))
    at = scratch_path(spark, "rows")
    with write_settings(spark):
        pieces.groupBy(*table.partition).agg(
            F.sum("_rows").alias("_rows"), F.sum("_keys").alias("_keys"), F.max("_rows").alias("_most")).write.parquet(at)
    parts = spark.read.parquet(at)
    hot = (F.col("_most") > TASK_ROWS) & (F.col("_most") > 4 * F.col("_rows") / PIECES)
    rows, keys, hot = parts.agg(F.sum("_rows"), F.sum("_keys"), F.max(hot)).first()
    if not rows or rows > 2 * keys or hot:
        return None
    big = parts.where(F.col("_rows") > room).select(
        *[F.col(c).alias(f"_big_{c}") for c in table.partition], F.ceil(F.col("_rows") / room).alias("_slices"))
    same = [F.col(c).eqNullSafe(F.col(f"_big_{c}")) for c in table.partition]
    # at most a row for every ``room`` rows
    told = df.join(F.broadcast(big), same, "left").withColumn(
        SLICE, F.pmod(digest, F.coalesce("_slices", F.lit(1)))).select(*df.columns, SLICE)
    tasks = -(-2 * rows // room)
    few = tasks <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    return told.repartition(*([] if few else [tasks]), *table.partition, SLICE)


def latest_dealt(df: DataFrame, table: KeyedLayout, seq: Sequence[str], times: int = 1) -> DataFrame:
    """The latest row of each primary key, dealt to tasks by the partition key
    and ready to be written, each row so many ``times``.  See ``write_keyed``."""
    from delaystats.operators.upsert import upsert

    aqe = _aqe_on(df.sparkSession)
    dealt = _deal(df, table, times) if aqe and table.partition else None
    if dealt is not None:
        return upsert(dealt, [*table.primary_key, SLICE], seq).drop(SLICE)
    latest = upsert(df, table.primary_key, seq)
    return latest.hint("rebalance", *table.partition) if aqe else latest.repartitionByRange(*table.primary_key)


def write_keyed(df: DataFrame, table: KeyedLayout, path: str, seq: Sequence[str],
                mode: str = "overwrite", **options) -> str:
    """Write ``df`` as the keyed table ``table``: one row per primary key,
    the last write (highest ``seq``) winning, partitioned by the table's
    partition key and sorted by its clustering columns.

    One shuffle and one sort: rows are dealt by partition key and slices of the
    clustering key (see ``_deal``), sorted by the primary key, and the latest of
    each key is written.  Where keys are written over and over there are two
    shuffles, both skew-safe: the upsert hashes on the full primary key (and
    keeps one row per key and task before it), the layout write rebalances on
    the partition key.
    """
    from delaystats.operators.upsert import upsert

    dealt = _deal(df, table) if _aqe_on(df.sparkSession) and not options.get("num_partitions") else None
    if dealt is not None:
        latest = upsert(dealt, [*table.primary_key, SLICE], seq).drop(SLICE)
        return write_partitioned(latest, path, partition_by=table.partition, cluster_by=table.clustering, mode=mode,
                                 dealt=True, **options)
    latest = upsert(df, table.primary_key, seq)
    return write_partitioned(latest, path, partition_by=table.partition,
                             cluster_by=table.clustering, mode=mode, **options)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int,
                   bucket_by: str | Sequence[str] = "uniquecarrier",
                   sort_by: tuple[str, ...] = ("year", "month", "flightnum", "day"),
                   steps_by: Sequence[str] = ()) -> str:
    """Write ``df`` in hash buckets.  With ``steps_by``, the partition key by
    which it is stored, a big table is written in steps (see ``in_steps``)."""
    keys = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
    # one exchange on the bucket key: a file per bucket and step, not tasks x buckets
    for i, step in enumerate(in_steps(df, steps_by) if steps_by else [df]):
        with write_settings(df.sparkSession):
            (step.repartition(buckets, *keys).write.mode("append" if i else "overwrite")
             .bucketBy(buckets, keys)
             .sortBy(*sort_by)
             .option("path", path)
             .format("parquet")
             .saveAsTable(table))
    return table


def bucket_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes per bucket of a bucketed layout, from a metadata-only listing
    (``binaryFile`` reads no content when ``content`` is not selected)."""
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length"))
    bucket = F.regexp_extract("path", r"_(\d{5})\.c\d{3}", 1).cast("int")
    return files.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("bytes"))


# A bucket above this size is too big for the one task that sorts, writes and
# scans it: wide rows take some twenty times their stored size in memory.
BUCKET_BYTES = 32 << 20


def bucket_count(spark: SparkSession, path: str, least: int = 8) -> int:
    """Buckets for rows now stored below ``path``: half of BUCKET_BYTES each."""
    return max(least, -(-stored_bytes(spark, path) // (BUCKET_BYTES // 2)))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``, from the store's own summary."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def read_bucketed(spark: SparkSession, table: str, path: str, buckets: int,
                  factor: float = 0.0, floor_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The bucketed table, scanned by bucket unless one bucket is too big.

    A bucketed scan reads each bucket in exactly one task: shuffle-free, but
    that task holds its whole bucket.  When the largest bucket exceeds
    ``floor_bytes`` (and ``factor`` x its fair share, if one is given), read
    the same files as plain Parquet instead: files split across tasks, and the
    consumer's partial aggregation / partial window limit absorbs a hot key
    before its shuffle.
    """
    stats = bucket_bytes(spark, path).agg(F.max("bytes").alias("mx"), F.sum("bytes").alias("tot")).first()
    mx, tot = (stats["mx"] or 0), (stats["tot"] or 0)
    if mx > floor_bytes and mx > factor * tot / max(buckets, 1):
        return spark.read.schema(spark.table(table).schema).parquet(path)
    return spark.table(table)


def read_layout(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a layout with its declared schema (partition values keep types)."""
    return spark.read.schema(schema).parquet(path)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own for footer counts: the caller's settings, and
    queries planned meanwhile, are not touched."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def native_count(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row ``n``: the row count answered from Parquet footers, moving no rows.

    The v2 Parquet scan pushes ``COUNT(*)`` into the files (each task reads
    footers only).  The frame is lazy and belongs to a session of its own.
    """
    return read_layout(_footer_session(spark), path, schema).agg(F.count(F.lit(1)).alias("n"))


def count_plan(spark: SparkSession, path: str, schema: T.StructType) -> str:
    """Formatted plan of the footer count (for plan assertions)."""
    from delaystats.plans.explain import plan_text
    return plan_text(native_count(spark, path, schema))
