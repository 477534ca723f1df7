"""Load-side row transforms: typed conversion, reject split, year fan-out.

A raw frame has the 29 text columns of the CSV (any further columns are
carried through untouched, e.g. a source sequence).  Conversion never throws:
each failing field turns into a ``reject_reason`` instead, and rejected rows
are returned, never dropped silently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from delaystats.functions import hhmm_arith, hhmm_valid, parse_date, try_int, valid_date
from delaystats.schema import COLUMNS, FANOUT_YEARS, HHMM_COLUMNS, INT_COLUMNS_V5

REASON = "reject_reason"
CORRUPT = "_corrupt_record"


def _passthrough(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in COLUMNS and c not in (CORRUPT, REASON)]


def _first_failure(checks: list[tuple[str, Column]], shape_ok: Column | None) -> Column:
    """Name of the first check (in column order) that fails."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        reason = F.when(~ok, F.lit(name)).otherwise(reason)
    if shape_ok is not None:
        reason = F.when(~shape_ok, F.lit("shape")).otherwise(reason)
    return reason


def _shape_ok(df: DataFrame) -> Column | None:
    return F.col(CORRUPT).isNull() if CORRUPT in df.columns else None


def _not_null(c: Column) -> Column:
    return c.isNotNull()


def v1_conversions() -> list[tuple[str, Column, Column]]:
    """(output column, converted value, accept check) of the v1 typed row,
    in check order.  Checks are cheap predicates on the raw text where one
    exists: a filter gets no common-subexpression sharing, so it must not
    re-run whole conversions."""
    ymd = try_int("year"), try_int("month"), try_int("day")
    conv = [("flightdate", parse_date(*ymd), valid_date(*ymd))]
    conv += [(c, try_int(c), _not_null(try_int(c))) for c in ["dayofweek"]]
    # accepted rows passed the HHMM check, so their value needs no re-check
    conv += [(c, hhmm_arith(c), F.coalesce(hhmm_valid(c), F.lit(False))) for c in HHMM_COLUMNS]
    conv += [(c, try_int(c), _not_null(try_int(c))) for c in ["arrdelay", "depdelay"]]
    return conv


def v5_conversions() -> list[tuple[str, Column, Column]]:
    return [(c, try_int(c), _not_null(try_int(c))) for c in INT_COLUMNS_V5]


def final_conversions() -> list[tuple[str, Column, Column]]:
    """The final table types only ``arrdelay`` (an int); every other column
    stays text, so a non-integer delay is the one way a row is rejected."""
    return [("arrdelay", try_int("arrdelay"), _not_null(try_int("arrdelay")))]


CONVERSIONS = {"v1": v1_conversions, "v5": v5_conversions, "final": final_conversions}


@dataclass
class Classified:
    """A raw frame with its typed projection and reject reason side by side."""

    frame: DataFrame          # raw columns + REASON
    typed: list[Column]       # projection of an accepted row
    raw_columns: list[str]

    @property
    def good(self) -> DataFrame:
        return self.frame.where(F.col(REASON).isNull()).select(*self.typed)

    @property
    def rejects(self) -> DataFrame:
        return self.frame.where(F.col(REASON).isNotNull()).select(*self.raw_columns, REASON)


def classify(raw: DataFrame, variant: str = "v5") -> Classified:
    """Attach ``reject_reason`` for the chosen typed variant.

    ``v1``: date from year/month/day, int dayofweek, four HHMM times as
    minutes, int delays; 29 -> 27 columns.  ``v5``: int year, month, day and
    both delays; 29 columns.  ``final``: int ``arrdelay`` only; 29 columns.
    """
    conversions = CONVERSIONS[variant]()
    converted = {name: value for name, value, _ in conversions}
    checks = [(name, ok) for name, _, ok in conversions]
    frame = raw.withColumn(REASON, _first_failure(checks, _shape_ok(raw)))
    extra = _passthrough(raw)
    if variant == "v1":
        order = ["flightdate"] + COLUMNS[3:]
    else:
        order = list(COLUMNS)
    typed = [converted[c].alias(c) if c in converted else F.col(c) for c in order]
    typed += [F.col(c) for c in extra]
    return Classified(frame, typed, list(COLUMNS) + extra)


def typed_load(raw: DataFrame, variant: str = "v5") -> tuple[DataFrame, DataFrame]:
    """(accepted typed rows, rejected raw rows with reason)."""
    c = classify(raw, variant)
    return c.good, c.rejects


def load_counts(raw: DataFrame, variant: str = "v5") -> DataFrame:
    """One row: how many rows a load accepts and rejects."""
    c = classify(raw, variant)
    bad = F.col(REASON).isNotNull()
    return c.frame.agg(
        F.count_if(~bad).cast("bigint").alias("loaded"),
        F.count_if(bad).cast("bigint").alias("rejected"),
    )


def load_layout(raw: DataFrame, path: str, variant: str = "v5",
                rejects_path: str | None = None, **layout_options) -> dict[str, int]:
    """Typed load of ``raw`` into the keyed layout at ``path``.

    Rows are counted while they are written: an ``Observation`` on the write
    job itself counts loaded and rejected rows in the same pass.  Rejected
    rows are written to ``rejects_path`` with their reason when given, and
    only if there are any (that costs a second pass over the input, which a
    clean load never pays).  Returns ``{"loaded": n, "rejected": m}``.

    When the layout writer samples its input (no AQE, or a fixed partition
    count), metrics below its exchange would count twice; then the accepted
    rows are observed after the exchange and the rejects counted apart.
    """
    from delaystats.sources.layout import samples_input, write_partitioned

    c = classify(raw, variant)
    bad = F.col(REASON).isNotNull()
    if not samples_input(raw.sparkSession, layout_options.get("num_partitions")):
        obs = Observation("load")
        observed = c.frame.observe(obs, F.count(F.lit(1)).alias("rows"),
                                   F.count_if(bad).alias("rejected"))
        write_partitioned(observed.where(~bad).select(*c.typed), path, **layout_options)
        n_rejected = obs.get["rejected"]
        n_loaded = obs.get["rows"] - n_rejected
        if rejects_path is not None and n_rejected:
            c.rejects.write.mode("append").parquet(rejects_path)
        return {"loaded": n_loaded, "rejected": n_rejected}

    loaded = Observation("loaded")
    write_partitioned(c.good, path, observation=loaded, **layout_options)
    if rejects_path is not None:
        rejected = Observation("rejected")
        (c.rejects.observe(rejected, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").parquet(rejects_path))
        n_rejected = rejected.get["rows"]
    else:
        n_rejected = c.rejects.count()
    return {"loaded": loaded.get["rows"], "rejected": n_rejected}


def year_fanout(df: DataFrame, years: tuple[int, int] = FANOUT_YEARS) -> DataFrame:
    """Emit every row once per year in the closed range, ``year`` overwritten."""
    lo, hi = years
    cols = [F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("year") if c == "year" else F.col(c)
            for c in df.columns]
    return df.select(*cols)
