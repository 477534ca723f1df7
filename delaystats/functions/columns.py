"""Column expressions: conversions and aggregates that stay JVM-side.

Every helper returns a ``Column`` so it fuses into whole-stage codegen; none
of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c: ColumnLike) -> Column:
    """Lenient integer read: NULL instead of an error for non-integers.

    Same result as ``try_cast(c AS INT)`` for every input, but cheap on dirty
    data: a failed cast costs an exception per value, so values that can
    never be integers (any letter, e.g. ``NA``, or empty) are NULL at once and
    only the rest goes through ``try_cast``.  (Kept to one check: generated
    code must stay small enough for the JIT.)
    """
    s = _col(c)
    return F.when(s.rlike("[A-Za-z]") | (s == ""), F.lit(None).cast("int")).otherwise(s.try_cast("int"))


# Valid HHMM text of 1-4 digits, read left-padded to four: hour 00-23,
# minute 00-59.  One anchored regex, so validity costs a single match.
HHMM_PATTERN = r"^(?:[0-9]|[0-5][0-9]|[0-9][0-5][0-9]|(?:[01][0-9]|2[0-3])[0-5][0-9])$"


def hhmm_valid(c: ColumnLike) -> Column:
    return _col(c).rlike(HHMM_PATTERN)


def hhmm_arith(c: ColumnLike) -> Column:
    """Minutes of HHMM text *already known valid* (no check; NULL-safe)."""
    padded = F.lpad(_col(c), 4, "0")
    return (padded.substr(1, 2).try_cast("int") * 60 + padded.substr(3, 2).try_cast("int")).cast("int")


def hhmm_minutes(c: ColumnLike) -> Column:
    """``HHMM`` text (1-4 digits, left-padded) to minutes after midnight.

    ``"905"`` is 09:05 = 545, ``"55"`` is 00:55 = 55; ``"2400"``, ``"2460"``,
    ``"NA"``, ``""`` and anything over four digits give NULL.
    """
    padded = F.lpad(_col(c), 4, "0")
    hours = padded.substr(1, 2).try_cast("int")
    minutes = padded.substr(3, 2).try_cast("int")
    return F.when(hhmm_valid(c), hours * 60 + minutes).cast("int")


def days_in_month(year: ColumnLike, month: ColumnLike) -> Column:
    y, m = _col(year), _col(month)
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return (F.when(m == 2, F.when(leap, 29).otherwise(28))
            .when(m.isin(4, 6, 9, 11), 30)
            .otherwise(31))


def valid_date(year: ColumnLike, month: ColumnLike, day: ColumnLike) -> Column:
    """The integer parts name a real calendar date (integer arithmetic only)."""
    y, m, d = _col(year), _col(month), _col(day)
    return (F.coalesce(y.between(1, 9999) & m.between(1, 12)
                       & d.between(F.lit(1), days_in_month(y, m)), F.lit(False)))


def parse_date(year: ColumnLike, month: ColumnLike, day: ColumnLike) -> Column:
    """Calendar date from integer parts; NULL if the parts are no real date."""
    y, m, d = _col(year), _col(month), _col(day)
    return F.when(valid_date(y, m, d), F.make_date(y, m, d))


def zero_sum(c: ColumnLike) -> Column:
    """SUM as DOUBLE, 0.0 (not NULL) over no rows."""
    return F.coalesce(F.sum(_col(c)).cast("double"), F.lit(0.0))
