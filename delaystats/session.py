"""Session construction and the shared scratch location.

Everything that must be written (staged CSVs, the keyed layout, lineage cuts)
goes below the folder the cluster names in ``spark.checkpoint.dir``.  A folder
of our own is only chosen when the session has none, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "delaystats") -> SparkSession:
    """A session configured the way every query in this package expects.

    AQE re-plans joins and coalesces shuffle partitions at runtime; the UI is
    off; timestamps are compared in UTC; ANSI mode stays on (we use ``try_*``);
    generated code too large for the JIT falls back to expression evaluation.
    """
    parts = shuffle_partitions or (16 if cores == "*" else max(8, 2 * int(cores)))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Generated methods above 8000 bytecodes are never JIT-compiled by
        # HotSpot and run interpreted (3x slower on the wide typed-load
        # projection); fall back to expression evaluation for those instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("DELAYSTATS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset, and
    only on a local master: executors elsewhere would not see a local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    base = configured or tempfile.mkdtemp(prefix="delaystats-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return "/".join([root.rstrip("/"), "delaystats", *parts, uuid.uuid4().hex])


#: What a job that writes wide rows runs with: generated methods that the JIT
#: compiles (see ``build_session``), splits whose rows, some twenty times as
#: big unpacked as in a Parquet file, a task can sort in memory, and shuffle
#: files that go when the write ends, not when the driver collects its garbage.
METHOD_BYTES = 8000
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT_BYTES = 16 << 20
_WRITES: dict[tuple, list] = {}
_WRITES_LOCK = threading.Lock()


@contextmanager
def write_settings(spark: SparkSession, split: bool = True) -> Iterator[None]:
    """The settings above while a write runs."""
    wanted = {"spark.sql.codegen.hugeMethodLimit": METHOD_BYTES, FREE_SHUFFLES: "true"}
    if split:
        wanted["spark.sql.files.maxPartitionBytes"] = SPLIT_BYTES
    with lowered(spark, wanted):
        yield


@contextmanager
def lowered(spark: SparkSession, wanted: dict[str, int | str]) -> Iterator[None]:
    """Settings of sizes, or lower ones that the session has, and any others as
    texts, for a while; the session has its own again after the last of nested
    or simultaneous uses."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    held = [(spark._jsparkSession.sessionUUID(), name) for name in wanted]
    with _WRITES_LOCK:
        for at in held:
            name = at[1]
            if at not in _WRITES:
                _WRITES[at] = [0, spark.conf.get(name), name in spark.conf.getAll]
                if isinstance(wanted[name], str) or int(size(_WRITES[at][1])) > wanted[name]:
                    spark.conf.set(name, str(wanted[name]))
            _WRITES[at][0] += 1
    try:
        yield
    finally:
        with _WRITES_LOCK:
            for at in held:
                _WRITES[at][0] -= 1
                if not _WRITES[at][0]:
                    _, before, own = _WRITES.pop(at)
                    if own:
                        spark.conf.set(at[1], before)
                    else:
                        spark.conf.unset(at[1])


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 256 << 20, max_partitions: int = 100_000) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on a cluster
    with ``total_cores`` executor cores.

    Shuffles start with about one partition per ``partition_bytes`` of input
    (at least two per core, at most ``max_partitions``: map x reduce shuffle
    blocks grow with the product); AQE then coalesces small partitions,
    splits skewed ones and turns joins with a small measured side into
    broadcasts.  Scans read ``partition_bytes`` per task.
    """
    parts = max(2 * total_cores, min(max_partitions, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark
