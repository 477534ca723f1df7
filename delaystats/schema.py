"""Column lists, typed variants and key definitions of the flight fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values (must equal the workload's own definitions) -------------
# The 29 positional columns of the on-time CSV, in file order.
COLUMNS = [
    "year", "month", "day", "dayofweek", "deptime", "crsdeptime", "arrtime",
    "crsarrtime", "uniquecarrier", "flightnum", "tailnum", "actualelapsedtime",
    "crselapsedtime", "airtime", "arrdelay", "depdelay", "origin", "dest",
    "distance", "taxiin", "taxiout", "cancelled", "cancellationcode", "diverted",
    "carrierdelay", "weatherdelay", "nasdelay", "securitydelay",
    "lateaircraftdelay",
]
# The carrier dimension used by the per-carrier and grid queries.
CARRIERS = [
    "WN", "UA", "OO", "NW", "MQ", "HA", "AA", "US", "AQ", "XE",
    "OH", "DL", "B6", "9E", "AS", "CO", "F9", "YV", "EV", "FL",
]
MONTHS = list(range(1, 13))
# Every loaded row is emitted once per year of this closed range.
FANOUT_YEARS = (2007, 2011)
# Rows per load group.
LOAD_BATCH_ROWS = 50_000
# Row limits of the top-k queries.
TOP_N = 100
LIMIT_PER_MONTH = 1000
# -------------------------------------------------------------------------

# Columns converted by each typed variant.
HHMM_COLUMNS = ["deptime", "crsdeptime", "arrtime", "crsarrtime"]
INT_COLUMNS_V5 = ["year", "month", "day", "arrdelay", "depdelay"]
# v1 merges year/month/day into one date and drops them: 29 -> 27 columns.
V1_COLUMNS = ["flightdate"] + COLUMNS[3:]


@dataclass(frozen=True)
class KeyedLayout:
    """Primary key of a keyed table: partition key + clustering columns."""

    name: str
    partition: tuple[str, ...]
    clustering: tuple[str, ...]

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.partition + self.clustering


LAYOUTS = {
    # typed v1 row; one partition per carrier, day-level flight key
    "by_carrier": KeyedLayout("by_carrier", ("uniquecarrier",), ("flightdate", "flightnum")),
    # all-text row; same uniqueness as by_carrier
    "by_carrier_ymd": KeyedLayout("by_carrier_ymd", ("uniquecarrier",),
                                  ("year", "month", "day", "flightnum")),
    # one row per flight number and month (no day in the key)
    "by_month": KeyedLayout("by_month", ("year", "month"), ("uniquecarrier", "flightnum")),
    # typed ints; one row per flight number and day
    "by_month_day": KeyedLayout("by_month_day", ("year", "month"),
                                ("uniquecarrier", "flightnum", "day")),
    # partition key (year, uniquecarrier, month); clustering chosen so that
    # (partition key + clustering) is the day-level flight key
    "by_carrier_month": KeyedLayout("by_carrier_month", ("year", "uniquecarrier", "month"),
                                    ("flightnum", "day")),
}

# Upsert uniqueness sets.
KEY_BY_DAY = ("year", "month", "uniquecarrier", "flightnum", "day")
KEY_BY_MONTH = ("year", "month", "uniquecarrier", "flightnum")


def all_string_schema(extra: T.StructType | None = None) -> T.StructType:
    """The CSV read schema: 29 text columns (+ optional typed extras)."""
    fields = [T.StructField(c, T.StringType(), True) for c in COLUMNS]
    if extra is not None:
        fields += list(extra.fields)
    return T.StructType(fields)


def v5_type(col: str) -> T.DataType:
    return T.IntegerType() if col in INT_COLUMNS_V5 else T.StringType()
