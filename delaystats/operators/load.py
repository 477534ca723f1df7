"""Loads that write accepted and rejected rows in one pass, in restartable steps.

``load_once`` converts every input row once and writes it once: a partition
column tells loaded rows from rejected ones, so one job makes both outputs and
counts both while it writes them.  ``load_groups`` numbers the input in groups
of a fixed size by its load sequence and commits them step by step in a ledger;
a load that was killed goes on with the groups the ledger does not have.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystats.operators.ingest import REASON, classify, year_fanout
from delaystats.operators.ordered import ordinal_within, parts_at
from delaystats.schema import FANOUT_YEARS, LOAD_BATCH_ROWS, KeyedLayout
from delaystats.sources.layout import in_steps, latest_dealt, write_partitioned

STATUS = "load_status"
LOADED, REJECTED = "loaded", "rejected"
RAW = "rejected_row"
GROUP = "load_group"
STEP = "load_step"
GROUP_ROWS = "load_group_rows"


def both_outcomes(raw: DataFrame, variant: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per raw row: its status, the typed columns if it is accepted,
    else the raw columns and the reason in ``rejected_row``.  ``keep`` names
    extra columns that stay in place either way."""
    c = classify(raw, variant)
    bad = F.col(REASON).isNotNull()
    names = c.frame.select(*c.typed).columns
    typed = [value if name in keep else F.when(~bad, value).alias(name) for name, value in zip(names, c.typed)]
    return c.frame.select(
        F.when(bad, REJECTED).otherwise(LOADED).alias(STATUS), *typed,
        F.when(bad, F.struct(*c.raw_columns, REASON)).alias(RAW))


def load_once(raw: DataFrame, path: str, variant: str = "v5", partition_by: tuple[str, ...] = ("year", "month"),
              cluster_by: tuple[str, ...] = ("uniquecarrier", "flightnum", "day"), **layout_options) -> dict[str, int]:
    """Load ``raw`` below ``path``: loaded rows typed, in directories of their
    partition key, rejected rows as they came, with the reason, in one of
    their own.  Returns ``{"loaded": n, "rejected": m}``, counted by the tasks
    that write."""
    seen = Observation("load")
    rejected = F.count_if(F.col(STATUS) == REJECTED)
    write_partitioned(both_outcomes(raw, variant), path, partition_by=(STATUS, *partition_by), cluster_by=cluster_by,
                      observation=seen, metrics=[(F.count(F.lit(1)) - rejected).alias(LOADED), rejected.alias(REJECTED)],
                      **layout_options)
    return {LOADED: seen.get[LOADED], REJECTED: seen.get[REJECTED]}


def _outcome(spark: SparkSession, path: str, status: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(STATUS, T.StringType())])
    return spark.read.schema(full).parquet(path).where(F.col(STATUS) == status).drop(STATUS)


def read_loaded(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The typed rows of a load; only their directories are read."""
    return _outcome(spark, path, LOADED, schema)


def read_rejected(spark: SparkSession, path: str, raw_schema: T.StructType) -> DataFrame:
    """The rejected rows of a load as they came, with their reason."""
    row = T.StructType([*raw_schema.fields, T.StructField(REASON, T.StringType())])
    rows = _outcome(spark, path, REJECTED, T.StructType([T.StructField(RAW, row)]))
    return rows.select(f"{RAW}.*")


def load_final(raw: DataFrame, path: str, staged: str, table: KeyedLayout, seq: Sequence[str], schema: T.StructType,
               years: tuple[int, int] = FANOUT_YEARS) -> dict[str, int]:
    """The final load path: convert (only ``arrdelay`` is typed), write every
    row once per year of ``years`` under the key of ``table``, last write wins.

    The input is converted once, into ``staged``, by the tasks that read it.
    The year of a row is overwritten, so the same rows win in every year:
    duplicates go, and rows are dealt to the tasks that write them, before the
    fan-out.  A big table is written in steps of whole months, one after the
    other: it is complete when this returns.  Counts are of written rows, one
    per year."""
    counts = load_once(raw, staged, "final", partition_by=("month",), dealt=True)
    rows = read_loaded(raw.sparkSession, staged, schema)
    keyed = KeyedLayout(table.name, *[tuple(c for c in part if c != "year") for part in (table.partition, table.clustering)])
    times = years[1] - years[0] + 1
    for i, step in enumerate(in_steps(rows, ["month"]) if "month" in keyed.primary_key else [rows]):
        latest = latest_dealt(step, keyed, seq, times)
        write_partitioned(year_fanout(latest, years), path, partition_by=table.partition, cluster_by=table.clustering,
                          mode="append" if i else "overwrite", dealt=True)
    return {k: v * times for k, v in counts.items()}


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(load_group, loaded, rejected) of every committed group."""
    return spark.read.schema(f"{STEP} int, {GROUP} long, {LOADED} long, {REJECTED} long").parquet(
        f"{path}/ledger").drop(STEP)


def load_groups(raw: DataFrame, path: str, seq: Sequence[str], variant: str = "final",
                group_rows: int = LOAD_BATCH_ROWS, steps: int = 8, stop_after: int | None = None) -> DataFrame:
    """Load ``raw`` in groups of ``group_rows`` rows by the total order ``seq``.

    * Rows are staged once, in ``steps`` steps of consecutive groups, by the
      tasks that read them: only keys are shuffled to find where steps begin.
    * A step numbers its groups by a distributed prefix sum, converts them,
      writes each as a directory, loaded and rejected rows apart, and then adds
      them with their counts to the ledger.  Its rows are shuffled once, and the
      next step begins when its shuffle files are gone.
    * Called again after a failure, it takes the staged rows as they are and
      does only the steps the ledger does not have; directories a dead run left
      behind are replaced.

    The layout of ``path``: ``staged``, ``groups``, ``ledger``.  Returns the
    ledger.  ``stop_after`` ends the run after so many steps (for tests).
    """
    spark = raw.sparkSession
    if not _exists(spark, f"{path}/staged/_SUCCESS"):
        rows = raw.count()
        each = max(1, -(-rows // (group_rows * steps))) * group_rows
        staged = parts_at(raw, seq, range(each + 1, rows + 1, each), name=STEP).withColumn(GROUP_ROWS, F.lit(group_rows))
        write_partitioned(staged, f"{path}/staged", partition_by=(STEP,), cluster_by=tuple(seq), mode="overwrite",
                          dealt=True)
    staged_rows = spark.read.parquet(f"{path}/staged")
    sizes = sorted(tuple(r) for r in staged_rows.groupBy(STEP, GROUP_ROWS).count().collect())
    firsts = dict(zip([s[0] for s in sizes], accumulate((s[2] for s in sizes), initial=0)))    # rows before a step
    done = set()
    if _exists(spark, f"{path}/ledger"):
        done = {r[STEP] for r in spark.read.schema(f"{STEP} int").parquet(f"{path}/ledger").distinct().collect()}
    for step, size, n in [s for s in sizes if s[0] not in done][:stop_after]:
        rows = staged_rows.where(F.col(STEP) == step).drop(STEP, GROUP_ROWS)
        number = F.floor((F.col("_place") + firsts[step] - 1) / size)
        placed = ordinal_within(rows, [], seq, name="_place").withColumn(GROUP, number.cast("long")).drop("_place")
        write_partitioned(both_outcomes(placed, variant, keep=[GROUP]), f"{path}/groups", partition_by=(GROUP, STATUS),
                          cluster_by=tuple(seq), mode="overwrite", dynamic=True, dealt=True)
        written = spark.read.schema(f"{GROUP} long, {STATUS} string").parquet(f"{path}/groups").where(
            F.col(GROUP).between(firsts[step] // size, (firsts[step] + n - 1) // size))
        counts = written.groupBy(GROUP).agg(
            F.count_if(F.col(STATUS) == LOADED).alias(LOADED), F.count_if(F.col(STATUS) == REJECTED).alias(REJECTED))
        counts.withColumn(STEP, F.lit(step)).coalesce(1).write.mode("append").parquet(f"{path}/ledger")
    return read_ledger(spark, path)
