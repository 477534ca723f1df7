"""The flight-shaped test table over the driver's ``lineitem`` parquet.

``flights_raw`` is what a CSV load would see: the 29 text columns plus five
``lineitem`` columns that together form a total order (the load sequence).
``flights`` is its typed, accepted part (the v5 conversion of the loader).
``flight_store`` is ``flights`` written once per session into the keyed
``year/month`` layout and read back, so that queries over it prune
partitions exactly as they would on the production table.

The recipe of ``flights_raw`` is fixed by FIXTURES.md section 2 so that the
DuckDB oracle can build the same rows from the same parquet.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystats.functions import parse_date
from delaystats.operators.ingest import classify
from delaystats.schema import CARRIERS, COLUMNS, v5_type
from delaystats.session import scratch_path
from delaystats.sources.layout import in_steps, read_layout, write_partitioned

# Load sequence: a total order over the rows (last write wins by it).
SEQ = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
SEQ_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_extendedprice", T.DoubleType()),
])

STORE_SCHEMA = T.StructType(
    [T.StructField(c, v5_type(c), True) for c in COLUMNS]
    + [T.StructField("flightdate", T.DateType(), True)]
    + list(SEQ_SCHEMA.fields)
)

FLIGHT_COLUMNS = ["year", "month", "day", "uniquecarrier", "flightnum", "deptime",
                  "arrdelay", "depdelay", "flightdate", *SEQ]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; spread over all cores if its files give fewer splits.

    A small Parquet file with one row group scans as one task; the per-row
    text building and conversion after it would then run on one core.  Large
    inputs already have more splits than cores and are left alone.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores)
    return df


def _s(c) -> F.Column:
    return c.cast("string")


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int")
    ret = F.col("l_returnflag") == "R"
    carrier = F.element_at(F.array(*[F.lit(c) for c in CARRIERS]), (sk % 20).cast("int") + 1)
    zero = F.lit("0")
    cols = {
        "year": _s(F.year("l_shipdate")),
        "month": _s(F.month("l_shipdate")),
        "day": _s(F.dayofmonth("l_shipdate")),
        "dayofweek": _s(ln),
        "deptime": _s((pk % 25) * 100 + ok % 60),
        "crsdeptime": _s((pk % 24) * 100 + ok % 60),
        "arrtime": _s(((pk + 2) % 24) * 100 + ok % 60),
        "crsarrtime": _s(((pk + 3) % 24) * 100 + ok % 60),
        "uniquecarrier": carrier,
        "flightnum": _s(ok % 500),
        "tailnum": F.concat(F.lit("N"), _s(sk)),
        "actualelapsedtime": _s(pk % 300),
        "crselapsedtime": _s(pk % 290),
        "airtime": _s(pk % 280),
        "arrdelay": F.when(ln == 7, F.lit("NA")).otherwise(_s(qty - 10)),
        "depdelay": _s(qty - 15),
        "origin": F.concat(F.lit("A"), _s(sk % 50)),
        "dest": F.concat(F.lit("A"), _s(pk % 50)),
        "distance": _s(pk),
        "taxiin": _s(ok % 9),
        "taxiout": _s(ok % 19),
        "cancelled": F.when(ret, F.lit("1")).otherwise(zero),
        "cancellationcode": F.when(ret, F.lit("A")).otherwise(F.lit("")),
        "diverted": zero, "carrierdelay": zero, "weatherdelay": zero,
        "nasdelay": zero, "securitydelay": zero, "lateaircraftdelay": zero,
    }
    return li.select(*[cols[c].alias(c) for c in COLUMNS], *SEQ)


def typed_flights(raw: DataFrame) -> DataFrame:
    """Accepted v5 rows of a raw frame plus the calendar date."""
    good = classify(raw, "v5").good
    return good.withColumn("flightdate", parse_date("year", "month", "day"))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed accepted rows computed on the fly (no layout)."""
    return typed_flights(flights_raw(spark, sf_dir)).select(*FLIGHT_COLUMNS)


_STORES: dict[tuple[str, str], str] = {}
_LOCKS: dict[tuple[str, str], threading.Lock] = defaultdict(threading.Lock)


def source_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Application, and the files of ``lineitem`` with their sizes and times as
    the store that Spark reads lists them (one listing per folder)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    todo, seen = [os.path.join(sf_dir, "lineitem.parquet")], []
    fs = fs_path(todo[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    while todo:
        for status in fs.listStatus(fs_path(todo.pop())):
            entry = status.toString()       # one call per file: path, length and times
            if "; isDirectory=true" in entry:
                todo.append(entry.split("path=", 1)[1].split("; isDirectory=")[0])
            else:
                seen.append(entry.split("; access_time=")[0])
    return spark.sparkContext.applicationId, hashlib.sha1("\n".join([sf_dir, *sorted(seen)]).encode()).hexdigest()


def build_store(spark: SparkSession, sf_dir: str, path: str | None = None) -> str:
    """Load ``flights_raw`` into the keyed ``year/month`` layout, a big one in
    steps of whole months; return its path."""
    path = path or scratch_path(spark, "store")
    raw = flights_raw(spark, sf_dir)
    typed = typed_flights(raw).select(*STORE_SCHEMA.fieldNames())
    for i, step in enumerate(in_steps(typed, ("year", "month"), at_most=raw.count())):
        write_partitioned(step, path, mode="append" if i else "overwrite")
    return path


def use_store(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Register an already built layout of ``sf_dir`` for this session."""
    _STORES[source_key(spark, sf_dir)] = path


def store_path(spark: SparkSession, sf_dir: str) -> str:
    key = source_key(spark, sf_dir)
    with _LOCKS[key]:
        if key not in _STORES:
            _STORES[key] = build_store(spark, sf_dir)
        return _STORES[key]


def flight_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed table: written once per session, then scanned with pruning."""
    return read_layout(spark, store_path(spark, sf_dir), STORE_SCHEMA)
