"""Counts, keyed sums, per-key aggregates, grids and date-range totals.

Every function takes the keyed table as a DataFrame and returns a DataFrame:
one Spark job per query, filters expressed as ``Column`` predicates so that
Catalyst turns them into ``PartitionFilters`` (year, month) and Parquet
``PushedFilters`` (carrier), aggregation partial before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaystats.functions import zero_sum
from delaystats.schema import CARRIERS, MONTHS

MEASURE = "arrdelay"


def _eq(**equalities) -> Column:
    cond = F.lit(True)
    for name, value in equalities.items():
        cond = cond & (F.col(name) == F.lit(value))
    return cond


# -- counts -----------------------------------------------------------------

def scan_count(df: DataFrame) -> DataFrame:
    """Number of rows (``count`` over a full scan)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# -- keyed sums ---------------------------------------------------------------

def key_sum(df: DataFrame, measure: str = MEASURE, **equalities) -> DataFrame:
    """SUM(measure) as DOUBLE for rows equal to all given key parts; 0.0 if none."""
    return df.where(_eq(**equalities)).agg(zero_sum(measure).alias("total"))


def partition_sum(df: DataFrame, year: int, carrier: str, month: int,
                  measure: str = MEASURE) -> DataFrame:
    """Sum for one full partition key (year, carrier, month)."""
    return key_sum(df, measure, year=year, uniquecarrier=carrier, month=month)


def filter_sum(df: DataFrame, year: int, carrier: str, measure: str = MEASURE) -> DataFrame:
    """Sum for a key subset (year, carrier): still pruned to one year."""
    return key_sum(df, measure, year=year, uniquecarrier=carrier)


def _month_dim(spark: SparkSession, months: Sequence[int]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(int(m)) for m in months])).alias("month"))


def split_sum(df: DataFrame, year: int, carrier: str, months: Sequence[int] = MONTHS,
              measure: str = MEASURE) -> DataFrame:
    """Per-month sums of (year, carrier), 0.0 for an empty month, and their
    total (``month`` NULL).

    The reference runs one job per month and adds the results on the driver;
    here one pruned scan is aggregated per month (partial + final), joined
    to the month list (at most len(months) rows each side) and rolled up, so
    every month and the total are present even when nothing matches.
    """
    rows = df.where(_eq(year=year, uniquecarrier=carrier) & F.col("month").isin(list(months)))
    per_month = rows.groupBy("month").agg(F.sum(measure).cast("double").alias("_m"))
    filled = (_month_dim(df.sparkSession, months)
              .join(F.broadcast(per_month), "month", "left")
              .select("month", F.coalesce("_m", F.lit(0.0)).alias("_m")))
    return (filled.rollup("month")
            .agg(F.sum("_m").alias("total"))
            .select(F.col("month").cast("int").alias("month"), "total"))


MONTH_SUM_SQL = """
SELECT CAST(m.id AS INT) AS month, CAST(COALESCE(s.total, 0) AS DOUBLE) AS total
FROM range(1, 13) AS m
LEFT JOIN (SELECT month, SUM({measure}) AS total
           FROM {{flights}}
           WHERE year = :year AND uniquecarrier = :carrier AND month BETWEEN 1 AND 12
           GROUP BY month) AS s
  ON s.month = m.id
"""


def sql_month_sum(spark: SparkSession, df: DataFrame, year: int, carrier: str,
                  measure: str = MEASURE) -> DataFrame:
    """The per-month aggregate as bound-parameter SQL text (0.0 for a month
    without rows, as a per-month statement would answer)."""
    return spark.sql(MONTH_SUM_SQL.format(measure=measure),
                     args={"year": year, "carrier": carrier}, flights=df)


# -- per-key aggregates -------------------------------------------------------

def carrier_sum(df: DataFrame, year: int, measure: str = MEASURE) -> DataFrame:
    return (df.where(F.col("year") == year)
            .groupBy("uniquecarrier")
            .agg(zero_sum(measure).alias("total")))


def carrier_avg(df: DataFrame, year: int, measure: str = MEASURE, digits: int = 6) -> DataFrame:
    return (df.where(F.col("year") == year)
            .groupBy("uniquecarrier")
            .agg(F.round(F.avg(F.col(measure).cast("double")), digits).alias("avg_delay")))


def key_grid(spark: SparkSession, carriers: Sequence[str] = CARRIERS,
             months: Sequence[int] = MONTHS) -> DataFrame:
    """All (carrier, month) cells of two small fixed lists."""
    return (spark.range(1)
            .select(F.explode(F.array(*[F.lit(c) for c in carriers])).alias("uniquecarrier"))
            .select("uniquecarrier",
                    F.explode(F.array(*[F.lit(int(m)) for m in months])).alias("month")))


def grid_sum(spark: SparkSession, df: DataFrame, year: int,
             carriers: Sequence[str] = CARRIERS, months: Sequence[int] = MONTHS,
             day: int | None = None, measure: str = MEASURE) -> DataFrame:
    """Sum for every (carrier, month) cell of the grid; absent cells are 0.0.

    One pruned scan and one partial/final aggregate instead of one job per
    cell.  Both join sides are bounded by len(carriers) x len(months) rows
    (the aggregate is restricted to the grid's keys before grouping), so the
    broadcast is safe at any data size.
    """
    cond = (F.col("year") == year) & F.col("uniquecarrier").isin(list(carriers)) \
        & F.col("month").isin(list(months))
    if day is not None:
        cond = cond & (F.col("day") == day)
    cells = (df.where(cond)
             .groupBy("uniquecarrier", "month")
             .agg(F.sum(measure).cast("double").alias("cell")))
    grid = key_grid(spark, carriers, months)
    return (grid.join(F.broadcast(cells), ["uniquecarrier", "month"], "left")
            .select("uniquecarrier", F.col("month").cast("int").alias("month"),
                    F.coalesce(F.col("cell"), F.lit(0.0)).alias("total")))


def grid_carrier_total(spark: SparkSession, df: DataFrame, year: int,
                       carriers: Sequence[str] = CARRIERS, months: Sequence[int] = MONTHS,
                       measure: str = MEASURE) -> DataFrame:
    """Per-carrier totals as sums of the zero-filled month cells."""
    return (grid_sum(spark, df, year, carriers, months, measure=measure)
            .groupBy("uniquecarrier").agg(F.sum("total").alias("total")))


# -- date ranges --------------------------------------------------------------

def _ym(d: dt.date) -> int:
    return d.year * 100 + d.month


def _as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def _month_prune(lo: dt.date, hi: dt.date) -> Column:
    """Redundant predicate on the partition columns, so ranges on the date
    column still prune ``year/month`` directories."""
    return (F.col("year") * 100 + F.col("month")).between(_ym(lo), _ym(hi))


def date_range_sum(df: DataFrame, carrier: str, lo: str | dt.date, hi: str | dt.date,
                   closed: bool, date_col: str = "flightdate", measure: str = MEASURE) -> DataFrame:
    """Sum over a date range: open (lo < d < hi) or closed (lo <= d <= hi)."""
    lo_d, hi_d = _as_date(lo), _as_date(hi)
    d = F.col(date_col)
    # make_date, as a date literal before the year 1000 is refused
    lo_c, hi_c = (F.make_date(F.lit(x.year), F.lit(x.month), F.lit(x.day)) for x in (lo_d, hi_d))
    in_range = d.between(lo_c, hi_c) if closed else (d > lo_c) & (d < hi_c)
    return (df.where(_month_prune(lo_d, hi_d) & (F.col("uniquecarrier") == carrier) & in_range)
            .agg(zero_sum(measure).alias("total")))


def calendar_month_ranges(year: int) -> list[tuple[dt.date, dt.date]]:
    """Closed (first day, last day) of every month of a year."""
    out = []
    for m in MONTHS:
        first = dt.date(year, m, 1)
        nxt = dt.date(year + (m == 12), m % 12 + 1, 1)
        out.append((first, nxt - dt.timedelta(days=1)))
    return out


def _running_totals(daily: DataFrame, wanted: DataFrame) -> DataFrame:
    """(day, total of all days up to it) for the days of ``wanted``.

    A distributed prefix sum over the calendar: running sums inside each month,
    plus the sum of the months before it (a window over one row per month)."""
    month = (F.year("day") * 12 + F.month("day")).alias("month")
    days = daily.select(month, "day", "v", F.lit(False).alias("asked"))
    points = wanted.select(month, "day", F.lit(None).cast(daily.schema["v"].dataType).alias("v"), F.lit(True).alias("asked"))
    events = days.unionByName(points)
    inside = Window.partitionBy("month").orderBy("day", "asked").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    months = events.groupBy("month").agg(F.sum("v").alias("v")).select("month", F.sum("v").over(before).alias("earlier"))
    running = events.withColumn("running", F.sum("v").over(inside)).where("asked")
    zero = F.lit(0)
    return running.join(months, "month").select(
        "day", (F.coalesce("running", zero) + F.coalesce("earlier", zero)).alias("total"))


def range_sums(spark: SparkSession, df: DataFrame, carrier: str,
               ranges: Sequence[tuple[str | dt.date, str | dt.date]],
               date_col: str = "flightdate", measure: str = MEASURE) -> DataFrame:
    """Closed-range sums for a list of (lo, hi) date ranges, one row per range.

    Rows are first added up per date; the sum of a range is then the running
    total at its last day less the one before its first day, so that n ranges
    over d days cost n + d steps, however long they are and however they
    overlap.  Both lookups are joins on the day with one row per asked day.  A
    range without rows, or with hi < lo, has the sum 0.  Sums of whole numbers
    and decimals are exact; DOUBLE measures round as sums do.
    """
    spans = [(_as_date(lo), _as_date(hi)) for lo, hi in ranges]
    rng = spark.createDataFrame(pa.table({
        "range_id": pa.array(range(1, len(spans) + 1), pa.int32()),
        "lo": pa.array([lo for lo, _ in spans], pa.date32()),
        "hi": pa.array([hi for _, hi in spans], pa.date32())}))
    lo_all = min((lo for lo, _ in spans), default=dt.date(1, 1, 1))
    hi_all = max((hi for _, hi in spans), default=dt.date(1, 1, 1))
    daily = (df.where((F.col("uniquecarrier") == carrier) & _month_prune(lo_all, hi_all))
             .groupBy(F.col(date_col).alias("day")).agg(F.sum(measure).alias("v")))
    asked = rng.select("range_id", "lo", "hi", F.date_sub("lo", 1).alias("before"))
    wanted = asked.select(F.explode(F.array("before", "hi")).alias("day")).distinct()
    totals = _running_totals(daily, wanted)
    upto = totals.select(F.col("day").alias("hi"), F.col("total").alias("upto"))
    until = totals.select(F.col("day").alias("before"), F.col("total").alias("until"))
    return (asked.join(upto, "hi").join(until, "before")
            .select("range_id", "lo", "hi", F.when(F.col("hi") >= F.col("lo"), (F.col("upto") - F.col("until")).cast("double"))
                    .otherwise(0.0).alias("total")))


# -- reshape --------------------------------------------------------------------

def key_by_delay(df: DataFrame, year: int, carrier: str, measure: str = MEASURE) -> DataFrame:
    """Rows keyed as (delay, (year, carrier)): the delay as FLOAT, a struct key."""
    return (df.where(_eq(year=year, uniquecarrier=carrier))
            .select(F.col(measure).cast("float").alias("delay"),
                    F.struct("year", "uniquecarrier").alias("key")))
