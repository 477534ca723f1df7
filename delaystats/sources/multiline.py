"""Quoted CSV whose fields may hold line ends, read in splits.

Spark reads such files whole (``multiLine``), one task a file.  Here they stay
split.  A line is read in one of two states, *outside* a quoted field or
*inside* one that an earlier line opened, and what a chunk (a split of a file)
does to the state does not depend on other chunks.  So:

1. every chunk is scanned for both starting states at once; only lines with a
   quote can change a state, and only those leave the JVM;
2. the chunks' functions are composed in file order (a window over one row per
   chunk): now the state at the start of every chunk is known;
3. one more scan joins lines to records.  A record that crosses a border
   comes out as fragments, at most two per chunk, which are put together by
   file; everything else is complete and is never shuffled.

A quote opens a field only at its start, as in the usual CSV dialect; inside,
two quotes stand for one.  The records are then parsed by Spark's CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import delaystats
from delaystats.operators.ingest import CORRUPT
from delaystats.schema import COLUMNS, all_string_schema

# The Arrow passes are pickled by value: workers need not import the package.
cloudpickle.register_pickle_by_value(delaystats)

_QUOTE, _SEPARATOR = '"', ","
#: What a chunk does to a state: (state after starting outside, after starting inside).
SAME = (0, 1)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of the line."""
    at = 0
    while True:
        if not inside:
            # the next field that begins with a quote
            while not line.startswith(_QUOTE, at):
                at = line.find(_SEPARATOR, at) + 1
                if not at:
                    return False
            at += 1
        # its end: a quote that is not one of two
        while True:
            at = line.find(_QUOTE, at) + 1
            if not at:
                return True
            if not line.startswith(_QUOTE, at):
                break
            at += 1
        inside = False
        at = line.find(_SEPARATOR, at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, at, value): lines with their chunk, in file order inside a task."""
    return (spark.read.option("lineSep", "\n").text(paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value"))


def _chunk_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with a quote, chunk by chunk -> one row per chunk: its function."""
    def row(chunk: tuple, function: tuple[int, int]) -> pa.RecordBatch:
        return pa.record_batch({"file": pa.array([chunk[0]], pa.string()), "at": pa.array([chunk[1]], pa.int64()),
                                "outside": pa.array([function[0]], pa.int32()),
                                "inside": pa.array([function[1]], pa.int32())})

    chunk, function = None, SAME
    for batch in batches:
        for file, at, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, at) != chunk:
                if chunk is not None:
                    yield row(chunk, function)
                chunk, function = (file, at), SAME
            after = int(ends_inside(line, False)), int(ends_inside(line, True))
            function = after[function[0]], after[function[1]]
    if chunk is not None:
        yield row(chunk, function)


def chunk_ends(lines: DataFrame) -> DataFrame:
    """(file, at, after) of the chunks with quotes: 1 if they end inside a field."""
    functions = lines.where(F.contains("value", F.lit(_QUOTE))).mapInArrow(
        _chunk_functions, "file string, at long, outside int, inside int")
    so_far = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # composition of functions on two states: the last constant one counts, then the swaps behind it
    rows = functions.select(
        "file", "at", F.when(F.col("outside") == F.col("inside"), F.col("outside")).alias("constant"),
        F.sum((F.col("outside") > F.col("inside")).cast("int")).over(so_far).alias("swaps"))
    reset = F.when(F.col("constant").isNotNull(), F.struct("constant", "swaps"))
    last = F.coalesce(F.last(reset, ignorenulls=True).over(so_far),
                      F.struct(F.lit(0).alias("constant"), F.lit(0).cast("long").alias("swaps")))
    rows = rows.withColumn("last", last)
    return rows.select("file", "at", F.pmod(F.col("last.constant") + F.col("swaps") - F.col("last.swaps"), F.lit(2))
                       .cast("int").alias("after"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order with the state ``start`` of their chunk -> records.

    ``kind`` 0: a whole record; 1: the end of one that an earlier chunk began;
    2: the beginning of one that goes on; 3: a chunk in the midst of one.
    ``first`` marks the first record of a file.
    """
    def rows(file: str, at: int, kind: int, first: bool, texts: list) -> pa.RecordBatch:
        n = len(texts)
        return pa.record_batch({
            "file": pa.array([file] * n, pa.string()), "at": pa.array([at] * n, pa.int64()),
            "kind": pa.array([kind] * n, pa.int32()), "first": pa.array([first] + [False] * (n - 1), pa.bool_()),
            "record": pa.array(texts, pa.string())})

    chunk, open_lines, crossing, new = None, [], False, False
    for batch in batches:
        files, places = batch.column("file"), batch.column("at")
        n = batch.num_rows
        change = [0, n]
        if n > 1:
            moved = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(places[1:], places[:-1]))
            change[1:1] = (pc.indices_nonzero(moved).to_numpy() + 1).tolist()
        for a, b in zip(change, change[1:]):
            if a == b:
                continue
            here = files[a].as_py(), places[a].as_py()
            if here != chunk:
                if open_lines:
                    yield rows(*chunk, 3 if crossing else 2, new, ["\n".join(open_lines)])
                chunk, open_lines = here, []
                crossing = inside = bool(batch.column("start")[a].as_py())
                new = here[1] == 0
            done = []
            for line in batch.column("value").slice(a, b - a).to_pylist():
                before = inside
                if _QUOTE in line:
                    inside = ends_inside(line, inside)
                if before or inside:
                    open_lines.append(line)
                    if inside:
                        continue
                    line, open_lines = "\n".join(open_lines), []
                    if crossing:
                        yield rows(*chunk, 1, False, [line])
                        crossing = False
                        continue
                done.append(line)
            if done:
                yield rows(*chunk, 0, new, done)
                new = False
    if open_lines:
        yield rows(*chunk, 3 if crossing else 2, new, ["\n".join(open_lines)])


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(first, record): the text of every record; ``first`` for the first of a
    file.  A quoted field that never ends makes the rest of its file one
    record, as any CSV reader does."""
    lines = _lines(spark, paths)
    # a chunk starts as the last earlier chunk of its file with a quote ended
    chunks = lines.select("file", "at").distinct().withColumn("after", F.lit(None).cast("int"))
    rows = chunks.unionByName(chunk_ends(lines)).groupBy("file", "at").agg(F.max("after").alias("after"))
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.withColumn("start", F.last("after", ignorenulls=True).over(earlier))
              .where("start = 1").select("file", "at", "start"))
    # at most a row per scan task, far less than the listing of files that plans the scan
    told = lines.join(F.broadcast(starts), ["file", "at"], "left").select("file", "at", "value", F.coalesce(
        "start", F.lit(0)).alias("start"))
    parts = told.mapInArrow(_records, "file string, at long, kind int, first boolean, record string")
    whole = parts.where("kind = 0").select("first", "record")
    # a fragment of kind 2 begins a record, those behind it up to the next one continue it
    w = Window.partitionBy("file").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    pieces = parts.where("kind > 0").withColumn("number", F.sum((F.col("kind") == 2).cast("int")).over(w))
    joined = pieces.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("at", "kind", "record"))).alias("parts"), F.max("first").alias("first"))
    crossing = joined.select("first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(crossing)


def read_multiline_csv(spark: SparkSession, paths: str | list[str], extra: T.StructType | None = None,
                       header: bool = True) -> DataFrame:
    """Like ``read_flights_csv`` (29 text columns, empty fields ``''``, short
    and long rows marked in ``_corrupt_record``), but a quoted field may hold
    line ends, and a big file is still read by many tasks.  Empty lines
    between records are skipped."""
    schema = all_string_schema(extra).add(T.StructField(CORRUPT, T.StringType(), True))
    records = read_records(spark, paths)
    if header:
        records = records.where(~F.col("first"))
    text = F.regexp_replace("record", "\r$", "")
    parsed = records.where(text != "").select(F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "), {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": _QUOTE, "escape": _QUOTE}).alias("row"))
    fields = set(COLUMNS)
    return parsed.select(*[
        F.coalesce(F.col("row")[c], F.lit("")).alias(c) if c in fields else F.col("row")[c].alias(c)
        for c in schema.fieldNames()])
