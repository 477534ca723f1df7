"""Run grouping and ordinals over a total order inside a scope, skew-safe.

``spanBy`` in the reference groups *consecutive* rows with an equal key.  The
textbook Spark form is ``lag`` + running ``sum`` over
``Window.partitionBy(scope).orderBy(order)``, but that window puts a whole
scope into one task: with one (year, month) holding a third of 100 TB, that
task never finishes.  Here every scope is cut into *chunks* of the order:

1. Split points of the full sort key (scope + order) come from a random
   sample of the key columns, about SAMPLE rows a chunk, picked on the JVM.
   They are data from then on, so the chunk of a row is a pure function of its
   key (a binary search): whichever task or retry evaluates it gets the same.
2. Windows over (scope, chunk) give positions or run breaks inside a chunk.
   Hash partitioning on (scope, chunk) spreads a hot scope over many tasks.
3. One summary row per (scope, chunk) is aggregated, and a window over the
   summaries of a scope turns them into offsets: rows before the chunk, or
   runs before it (a run goes on across a border when the last key of one
   chunk equals the first key of the next).

Scopes that all fit a task (checked by a count) are left whole: one window, no
offsets, the same rows.  Everything runs on the JVM, so no value changes on its way, whatever its type.
The order must be total inside a scope; equal sort keys share a chunk.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from delaystats.session import scratch_path, write_settings

CHUNK = "_chunk"
BEFORE = "_before"
CHUNK_ROWS = 4_000_000      # a scope above this is always cut
LEAST_ROWS = 4_096          # a scope below this is never cut
SAMPLE = 30                 # sampled keys per chunk
# Segment tables smaller than this are broadcast; otherwise a shuffle join.
SEGMENT_BROADCAST_ROWS = 200_000


def split_points(df: DataFrame, scope: Sequence[str], key: Sequence[str],
                 chunks: int | None = None) -> DataFrame | None:
    """The sorted keys that start a new chunk (one row, ``points``, written
    once so that no value changes on its way), or None where every scope fits
    one task: no scope then holds more than LEAST_ROWS rows or two tasks' fair
    share of them.  Two jobs over the key columns: rows per scope, and a
    sample of some SAMPLE x chunks rows (at most SAMPLE x rows / LEAST_ROWS)."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = df.groupBy(*scope).agg(F.count(F.lit(1)).alias("n"))
    most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    if chunks is None:
        room = max(LEAST_ROWS, min(2 * rows // tasks, CHUNK_ROWS)) if rows else 0
        chunks = 1 if not rows or most <= room else 4 * rows // room
    if chunks <= 1 or not rows:
        return None
    drawn = (df.select(F.struct(*key).alias("k")).sample(min(1.0, SAMPLE * chunks / rows), seed=17)
             .agg(F.sort_array(F.collect_list("k")).alias("all")))
    step = F.size("all") / F.lit(float(chunks))
    picked = F.transform(F.sequence(F.lit(1), F.lit(chunks - 1)), lambda i: F.get("all", F.floor(i * step).cast("int")))
    return _materialize(drawn.select(F.array_distinct(F.filter(picked, lambda p: p.isNotNull())).alias("points")), "points")


def in_chunks(df: DataFrame, within: Sequence[str], order: Sequence[str], chunks: int | None = None) -> DataFrame | None:
    """``df`` with the chunk of each row in ``_chunk``: the number of split
    points at or before its key, by binary search.  None for a single chunk."""
    key = list(dict.fromkeys([*within, *order]))
    points = split_points(df, within, key, chunks)
    if points is None:
        return None
    return _found(df, key, points).drop("_points")


def _found(df: DataFrame, key: Sequence[str], points: DataFrame) -> DataFrame:
    """``df`` with the number of ``points`` at or before the key of each row in
    ``_chunk``, and the points themselves in ``_points``."""
    steps = [1 << b for b in reversed(range(points.select(F.size("points")).first()[0].bit_length()))]
    at = F.col("_points")

    def search(own):
        return F.aggregate(F.array(F.lit(0), *map(F.lit, steps)), F.lit(0), lambda low, step: F.call_function(
            "if", (step > 0) & (F.get(at, low + step - 1) <= own), low + step, low))

    chunk = F.transform(F.array(F.struct(*key)), search)[0]     # the key is put together once a row
    return df.withColumn("_points", points.scalar()).withColumn(CHUNK, chunk)


def _materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    read it back: one job, lineage cut, every consumer sees the same rows."""
    path = scratch_path(df.sparkSession, what)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small_join(big: DataFrame, small: DataFrame, on: list[str], max_rows: int,
                small_rows: int) -> DataFrame:
    """Broadcast ``small`` only if its checked size (``small_rows``) is under
    ``max_rows``; else a shuffle join."""
    if small_rows <= max_rows:
        small = F.broadcast(small)
    small = small.withColumnsRenamed({c: f"_s_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in on]      # a null scope is a scope
    return big.join(small, same).drop(*[f"_s_{c}" for c in on])


@dataclass
class Spans:
    """Run pieces of a frame plus their segment offsets (see module doc)."""

    pieces: DataFrame               # scope, _chunk, local_run, key, total, n; written if there are segments
    segments: DataFrame | None      # scope, _chunk, n_runs, cont, offset, next_cont; None: every scope is whole
    scope: list[str]
    key: str
    n_segments: int                 # size check for the segment broadcast

    def runs(self) -> DataFrame:
        """One row per run: scope, ``run`` (1-based per scope), key, ``total``."""
        if self.segments is None:
            return self.pieces.select(*self.scope, F.col("local_run").alias("run"), self.key, "total")
        j = _small_join(self.pieces, self.segments, [*self.scope, CHUNK], SEGMENT_BROADCAST_ROWS,
                        self.n_segments)
        j = j.withColumn("run", (F.col("offset") + F.col("local_run") - F.col("cont")).cast("bigint"))
        boundary = (((F.col("local_run") == 1) & (F.col("cont") == 1))
                    | ((F.col("local_run") == F.col("n_runs")) & (F.col("next_cont") == 1)))
        out = [*self.scope, "run", self.key]
        interior = j.where(~boundary).select(*out, "total")
        # only pieces at a chunk border can belong to a run of several pieces
        merged = j.where(boundary).groupBy(*out).agg(F.sum("total").cast(j.schema["total"].dataType).alias("total"))
        return interior.unionByName(merged)

    def count(self) -> DataFrame:
        """Number of runs (one row, ``n``)."""
        if self.segments is None:
            return self.pieces.agg(F.count(F.lit(1)).alias("n"))
        return self.segments.agg(
            F.coalesce(F.sum(F.col("n_runs") - F.col("cont")), F.lit(0)).cast("bigint").alias("n"))


def span_by(df: DataFrame, key: str, order: Sequence[str], within: Sequence[str],
            value: str, num_partitions: int | None = None) -> Spans:
    """Group consecutive rows with equal ``key`` (in ``order``, inside each
    ``within`` scope) and sum ``value`` per run; a null key is a run of its own.

    ``order`` must be a total order inside the scope; runs never cross a
    scope boundary.  ``num_partitions`` fixes the number of chunks.  The run
    pieces of cut scopes are written once to the checkpoint folder (an action
    runs here), and their segments are counted by the write itself.
    """
    scope = list(within)
    narrow = df.select(*dict.fromkeys([*scope, *order, key, value]))
    cut = in_chunks(narrow, scope, order, num_partitions)
    rows = narrow.withColumn(CHUNK, F.lit(0)) if cut is None else cut
    parts = scope if cut is None else [*scope, CHUNK]
    w = Window.partitionBy(*parts).orderBy(*order)
    rows = rows.withColumn("_break", F.when(F.lag(key).over(w) == F.col(key), 0).otherwise(1).cast("bigint"))
    rows = rows.withColumn("local_run", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = rows.groupBy(*parts, "local_run").agg(
        F.first(key).alias(key), F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
    if cut is None:
        return Spans(pieces, None, scope, key, 0)
    seen = Observation("segments")
    pieces = _materialize(pieces.observe(seen, F.count_if(F.col("local_run") == 1).alias("n")), "spans")

    segs = pieces.groupBy(*scope, CHUNK).agg(
        F.max("local_run").alias("n_runs"), F.min_by(key, "local_run").alias("first_key"),
        F.max_by(key, "local_run").alias("last_key"))
    w = Window.partitionBy(*scope).orderBy(CHUNK)
    segs = segs.withColumn("cont", F.coalesce((F.lag("last_key").over(w) == F.col("first_key")).cast("int"), F.lit(0)))
    segs = segs.select(
        *scope, CHUNK, "n_runs", "cont",
        F.coalesce(F.sum(F.col("n_runs") - F.col("cont")).over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.coalesce(F.lead("cont").over(w), F.lit(0)).alias("next_cont"))
    return Spans(pieces, segs, scope, key, seen.get["n"])


def ordinal_within(df: DataFrame, within: Sequence[str], order: Sequence[str],
                   name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: 1-based position of each row in ``order`` inside its scope.

    Equal to ``row_number()`` over ``partitionBy(within).orderBy(order)`` for
    a total order, as a distributed prefix sum: the rows before a chunk are a
    sum over column-pruned counts per (scope, chunk).  Each count travels to
    its chunk as one extra row that sorts first, so that the rows themselves
    are shuffled once and joined with nothing.  ``df`` must give the same rows
    each time it is evaluated; nothing is written.
    """
    scope, cols = list(within), list(df.columns)
    rows = in_chunks(df, scope, order, num_partitions)
    if rows is None:
        w = Window.partitionBy(*scope).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    counts = rows.groupBy(*scope, CHUNK).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*scope).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    heads = counts.select(*scope, CHUNK, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(BEFORE))
    both = rows.withColumn(BEFORE, F.lit(None).cast("bigint")).unionByName(heads, allowMissingColumns=True)
    w = Window.partitionBy(*scope, CHUNK).orderBy(F.col(BEFORE).isNull(), *order)
    first = F.first(BEFORE).over(w.rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn(name, (first + F.row_number().over(w) - 1).cast("bigint"))
    return both.where(F.col(BEFORE).isNull()).select(*cols, name)


def parts_at(df: DataFrame, order: Sequence[str], starts: Sequence[int], name: str = "part") -> DataFrame:
    """Add ``name``: how many of ``starts`` (ascending places, from 1 on, in the
    total order of all rows) are at or before the place of each row.

    Only the key columns are sorted and shuffled, to find the keys at ``starts``;
    the rows stay in the tasks that read them.  Rows whose equal keys fall into
    several parts are numbered apart.  ``df`` must give the same rows each time
    it is evaluated.
    """
    key, cols = list(order), list(df.columns)
    if not starts:
        return df.withColumn(name, F.lit(0))
    placed = ordinal_within(df.select(*key), [], key, name="_place").where(F.col("_place").isin(list(starts)))
    with write_settings(df.sparkSession):
        points = _materialize(placed.agg(
            F.array_distinct(F.sort_array(F.collect_list(F.struct(*key)))).alias("points")), "starts")
    rows = _found(df, key, points)
    at_point = F.coalesce(F.get("_points", F.col(CHUNK) - 1) == F.struct(*key), F.lit(False))
    rows = rows.withColumn("_same", at_point).drop("_points")
    sizes = {(r[CHUNK], r["_same"]): r["count"] for r in rows.groupBy(CHUNK, "_same").count().collect()}
    place, parts, tied = 1, {}, {}
    for at in sorted(sizes, key=lambda at: (at[0], not at[1])):     # the rows at a point come before those after it
        parts[at] = bisect_right(starts, place)
        if bisect_right(starts, place + sizes[at] - 1) != parts[at]:
            tied[at[0]] = place                                     # only equal keys can
        place += sizes[at]

    def told(of: dict) -> Column:
        return F.get(F.array(*[F.lit(of.get(i)) for i in range(max(c for c, _ in sizes) + 1)]), F.col(CHUNK))

    known = F.when(F.col("_same"), told({c: p for (c, same), p in parts.items() if same})).otherwise(
        told({c: p for (c, same), p in parts.items() if not same}))
    tie = F.col("_same") & F.col(CHUNK).isin(list(tied))
    plain = (rows.where(~tie) if tied else rows).withColumn(name, known.cast("int")).select(*cols, name)
    if not tied:
        return plain
    own = told(tied) + F.row_number().over(Window.partitionBy(CHUNK).orderBy(*key)) - 1
    part = F.size(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= F.col("_place")))
    return plain.unionByName(rows.where(tie).withColumn("_place", own).withColumn(name, part).select(*cols, name))
