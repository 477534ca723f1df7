"""Top-k, per-group limits and previews.

All limits carry an explicit total order (ties broken by the caller's
columns), so results do not depend on task scheduling.  ``orderBy().limit()``
plans as ``TakeOrderedAndProject`` (per-task top-k, then a merge of k rows
per task) instead of the reference's full range-shuffle sort; a
``row_number() <= n`` filter plans as ``WindowGroupLimit`` partial + final,
so at most n rows per group and task cross the shuffle even for a hot group.
Spark plans that up to a limit of 1000; beyond it salted limits are merged in a
tree (``_pre_limited``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaystats.schema import LIMIT_PER_MONTH, TOP_N


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, by: str, n: int, tiebreak: Sequence[str | Column] = (),
          descending: bool = True) -> DataFrame:
    first = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(first, *_order(tiebreak)).limit(n)


def top_delays(df: DataFrame, year: int, carrier: str, n: int = TOP_N,
               tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """The n largest delays of (year, carrier) as (FLOAT delay, year, carrier)."""
    rows = df.where((F.col("year") == year) & (F.col("uniquecarrier") == carrier))
    return (top_n(rows, "arrdelay", n, tiebreak)
            .select(F.col("arrdelay").cast("float").alias("arrdelay"), "year", "uniquecarrier"))


# Above this Spark plans no WindowGroupLimit, so whole groups would be sorted.
GROUP_LIMIT = 1000
SALTS = 16                  # parts that a round of pre-limits merges into one


def _pre_limited(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """``df`` without rows that cannot be among the first ``n`` of their group.

    Up to GROUP_LIMIT rows the window itself plans as a group limit.  Above, a
    tree of salted limits does it: rows are dealt to SALTS ** rounds parts of
    their group by a hash of the order columns, each part keeps its first
    ``n``, and SALTS parts at a time are merged, so that no task sorts more
    than a part of a group or SALTS x n rows.  Only the last round, that of
    the caller, sees a group whole: SALTS x n rows of it at most.
    """
    if n <= GROUP_LIMIT:
        return df
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while SALTS ** rounds < tasks:
        rounds += 1
    values = [F.col(c) for c in df.columns]
    out = df.withColumn("_salt", F.pmod(F.xxhash64(*values), F.lit(SALTS ** rounds)))
    for _ in range(rounds):
        w = Window.partitionBy(*group, "_salt").orderBy(*order)
        out = out.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= n)
        out = out.withColumn("_salt", F.floor(F.col("_salt") / SALTS))
    return out.drop("_salt", "_place")


def limit_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                    n: int, rank_name: str | None = None) -> DataFrame:
    """At most n rows per group, the first ones in ``order``."""
    cols = _order(order)
    df = _pre_limited(df, group, cols, n)
    w = Window.partitionBy(*group).orderBy(*cols)
    rn = "_rn" if rank_name is None else rank_name
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out.drop("_rn") if rank_name is None else out


def limit_per_month(df: DataFrame, year: int, carrier: str, clustering: Sequence[str],
                    n: int = LIMIT_PER_MONTH) -> DataFrame:
    """Per month of (year, carrier): the first n rows in clustering order."""
    rows = df.where((F.col("year") == year) & (F.col("uniquecarrier") == carrier)
                    & F.col("month").between(1, 12))
    return limit_per_group(rows, ["month"], clustering, n)


def take_first(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """Preview: the first n rows in an explicit order."""
    return df.orderBy(*_order(order)).limit(n)


def top_per_group(df: DataFrame, group: Sequence[str], by: str, n: int,
                  tiebreak: Sequence[str | Column] = (), rank_name: str = "rank") -> DataFrame:
    """The n largest ``by`` values of every group, ranked 1..n."""
    return limit_per_group(df, group, [F.col(by).desc(), *_order(tiebreak)], n, rank_name)
