"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement rebuilds ``flights_raw`` / ``flights`` from the ``lineitem``
view with the recipe of FIXTURES.md section 2 and then states the query in
plain SQL: an independent formulation to compare the Spark plans against.
"""

from __future__ import annotations

import datetime as dt

from delaystats.operators.measures import calendar_month_ranges
from delaystats.schema import CARRIERS, COLUMNS, FANOUT_YEARS, LIMIT_PER_MONTH, LOAD_BATCH_ROWS, TOP_N

FLIGHTS_CTE = """
WITH flights_raw AS (
  SELECT CAST(year(l_shipdate) AS STRING) AS year,
         CAST(month(l_shipdate) AS STRING) AS month,
         CAST(day(l_shipdate) AS STRING) AS day,
         CAST(l_linenumber AS STRING) AS dayofweek,
         CAST((l_partkey % 25) * 100 + l_orderkey % 60 AS STRING) AS deptime,
         CAST((l_partkey % 24) * 100 + l_orderkey % 60 AS STRING) AS crsdeptime,
         CAST(((l_partkey + 2) % 24) * 100 + l_orderkey % 60 AS STRING) AS arrtime,
         CAST(((l_partkey + 3) % 24) * 100 + l_orderkey % 60 AS STRING) AS crsarrtime,
         split_part('WN,UA,OO,NW,MQ,HA,AA,US,AQ,XE,OH,DL,B6,9E,AS,CO,F9,YV,EV,FL', ',',
                    CAST(l_suppkey % 20 AS INT) + 1) AS uniquecarrier,
         CAST(l_orderkey % 500 AS STRING) AS flightnum,
         concat('N', CAST(l_suppkey AS STRING)) AS tailnum,
         CAST(l_partkey % 300 AS STRING) AS actualelapsedtime,
         CAST(l_partkey % 290 AS STRING) AS crselapsedtime,
         CAST(l_partkey % 280 AS STRING) AS airtime,
         CASE WHEN l_linenumber = 7 THEN 'NA'
              ELSE CAST(CAST(l_quantity AS INT) - 10 AS STRING) END AS arrdelay,
         CAST(CAST(l_quantity AS INT) - 15 AS STRING) AS depdelay,
         concat('A', CAST(l_suppkey % 50 AS STRING)) AS origin,
         concat('A', CAST(l_partkey % 50 AS STRING)) AS dest,
         CAST(l_partkey AS STRING) AS distance,
         CAST(l_orderkey % 9 AS STRING) AS taxiin,
         CAST(l_orderkey % 19 AS STRING) AS taxiout,
         CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS cancelled,
         CASE WHEN l_returnflag = 'R' THEN 'A' ELSE '' END AS cancellationcode,
         '0' AS diverted, '0' AS carrierdelay, '0' AS weatherdelay,
         '0' AS nasdelay, '0' AS securitydelay, '0' AS lateaircraftdelay,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem
),
flights AS (
  SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month, CAST(day AS INT) AS day,
         uniquecarrier, flightnum, deptime, CAST(arrdelay AS INT) AS arrdelay,
         CAST(depdelay AS INT) AS depdelay,
         make_date(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT)) AS flightdate,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM flights_raw
  WHERE TRY_CAST(arrdelay AS INT) IS NOT NULL AND TRY_CAST(depdelay AS INT) IS NOT NULL
)
"""

SEQ_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
SEQ_DESC_SQL = ", ".join(f"{c} DESC" for c in SEQ_SQL.split(", "))
RUN_ORDER_SQL = f"day, flightnum, {SEQ_SQL}"
CLUSTER_ORDER_SQL = f"flightnum, day, {SEQ_SQL}"


def _q(body: str) -> str:
    return FLIGHTS_CTE + body


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def hhmm_sql(c: str) -> str:
    p = f"lpad({c}, 4, '0')"
    h, m = f"TRY_CAST(substr({p}, 1, 2) AS INTEGER)", f"TRY_CAST(substr({p}, 3, 2) AS INTEGER)"
    return (f"CASE WHEN regexp_full_match({c}, '[0-9]{{1,4}}') AND {h} < 24 AND {m} < 60 "
            f"THEN CAST({h} * 60 + {m} AS INTEGER) END")


def date_sql(y: str, m: str, d: str) -> str:
    yi, mi, di = (f"TRY_CAST({x} AS INTEGER)" for x in (y, m, d))
    return (f"CASE WHEN {yi} BETWEEN 1 AND 9999 AND {mi} BETWEEN 1 AND 12 AND {di} BETWEEN 1 AND 31 "
            f"THEN TRY_CAST(printf('%04d-%02d-%02d', {yi}, {mi}, {di}) AS DATE) END")


V1_SQL = {
    "flightdate": date_sql("year", "month", "day"),
    "dayofweek": "TRY_CAST(dayofweek AS INTEGER)",
    "deptime": hhmm_sql("deptime"),
    "crsdeptime": hhmm_sql("crsdeptime"),
    "arrtime": hhmm_sql("arrtime"),
    "crsarrtime": hhmm_sql("crsarrtime"),
    "arrdelay": "TRY_CAST(arrdelay AS INTEGER)",
    "depdelay": "TRY_CAST(depdelay AS INTEGER)",
}
V5_SQL = {c: f"TRY_CAST({c} AS INTEGER)" for c in ["year", "month", "day", "arrdelay", "depdelay"]}


def _typed_select(conv: dict[str, str], order: list[str]) -> str:
    return ", ".join(f"{conv[c]} AS {c}" if c in conv else c for c in order)


def _reason(conv: dict[str, str]) -> str:
    whens = " ".join(f"WHEN ({e}) IS NULL THEN '{c}'" for c, e in conv.items())
    return f"CASE {whens} END"


def _ok(conv: dict[str, str]) -> str:
    return " AND ".join(f"({e}) IS NOT NULL" for e in conv.values())


def _ranges_values(year: int) -> str:
    rows = ", ".join(f"({i + 1}, DATE '{lo}', DATE '{hi}')"
                     for i, (lo, hi) in enumerate(calendar_month_ranges(year)))
    return f"(VALUES {rows}) r(range_id, lo, hi)"


def build(year: int, carrier: str, month: int, empty_year: int,
          range_lo: dt.date, range_hi: dt.date) -> dict[str, str]:
    yc = f"year = {year} AND uniquecarrier = '{carrier}'"
    zsum = "CAST(COALESCE(sum(arrdelay), 0) AS DOUBLE)"
    span = f"""
SELECT year, month, CAST(run AS BIGINT) AS run, uniquecarrier, CAST(sum(arrdelay) AS BIGINT) AS total
FROM (SELECT *, sum(brk) OVER (PARTITION BY year, month ORDER BY {RUN_ORDER_SQL}
             ROWS UNBOUNDED PRECEDING) AS run
      FROM (SELECT *, CASE WHEN lag(uniquecarrier) OVER (PARTITION BY year, month
                     ORDER BY {RUN_ORDER_SQL}) = uniquecarrier THEN 0 ELSE 1 END AS brk
            FROM flights) t) u
GROUP BY year, month, run, uniquecarrier"""

    token = "md5(concat(CAST(year AS STRING), ':', uniquecarrier, ':', CAST(month AS STRING)))"
    token_order = f"{token}, uniquecarrier, month, flightnum, day, {SEQ_SQL}"
    year_span = f"""
SELECT year, CAST(run AS BIGINT) AS run, uniquecarrier, CAST(sum(arrdelay) AS BIGINT) AS total
FROM (SELECT *, sum(brk) OVER (PARTITION BY year ORDER BY {token_order} ROWS UNBOUNDED PRECEDING) AS run
      FROM (SELECT *, CASE WHEN lag(uniquecarrier) OVER (PARTITION BY year ORDER BY {token_order})
                             = uniquecarrier THEN 0 ELSE 1 END AS brk
            FROM flights WHERE year = {year}) t) u
GROUP BY year, run, uniquecarrier"""

    def upsert(key: str, table: str = "flights") -> str:
        return f"""
SELECT year, month, day, uniquecarrier, flightnum, arrdelay
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {SEQ_DESC_SQL}) AS rn
      FROM {table}) t
WHERE rn = 1"""

    day_key = "year, month, uniquecarrier, flightnum, day"
    ok_final = "TRY_CAST(arrdelay AS INTEGER) IS NOT NULL"
    n_years = FANOUT_YEARS[1] - FANOUT_YEARS[0] + 1
    outcome = f"""
SELECT CASE WHEN reason IS NULL THEN 'loaded' ELSE 'rejected' END AS outcome, reason
FROM (SELECT CASE WHEN l_orderkey % 11 = 0 OR l_orderkey % 13 = 0 THEN 'shape' ELSE {_reason(V5_SQL)} END AS reason
      FROM flights_raw) t"""

    def grid(extra: str) -> str:
        return f"""
SELECT c.uniquecarrier, CAST(m.month AS INTEGER) AS month, COALESCE(CAST(a.total AS DOUBLE), 0.0) AS total
FROM (SELECT unnest([{_list(CARRIERS)}]) AS uniquecarrier) c
CROSS JOIN (SELECT unnest(range(1, 13)) AS month) m
LEFT JOIN (SELECT uniquecarrier, month, sum(arrdelay) AS total FROM flights
           WHERE year = {year}{extra} GROUP BY uniquecarrier, month) a
  ON a.uniquecarrier = c.uniquecarrier AND a.month = m.month"""

    lo_hi = f"DATE '{range_lo}'", f"DATE '{range_hi}'"
    flo, fhi = FANOUT_YEARS
    v1_order = ["flightdate"] + COLUMNS[3:]

    q = {
        "native_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM flights",
        "scan_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM flights",
        "partition_sum": f"SELECT {zsum} AS total FROM flights WHERE {yc} AND month = {month}",
        "empty_sum": f"SELECT {zsum} AS total FROM flights "
                     f"WHERE year = {empty_year} AND uniquecarrier = '{carrier}' AND month = {month}",
        "filter_sum": f"SELECT {zsum} AS total FROM flights WHERE {yc}",
        "split_sum": f"""
SELECT CAST(m.month AS INTEGER) AS month, CAST(sum(COALESCE(s.t, 0)) AS DOUBLE) AS total
FROM (SELECT unnest(range(1, 13)) AS month) m
LEFT JOIN (SELECT month, sum(arrdelay) AS t FROM flights WHERE {yc} GROUP BY month) s
  ON s.month = m.month
GROUP BY ROLLUP (m.month)""",
        "sql_month_sum": f"""
SELECT CAST(m.month AS INTEGER) AS month, CAST(COALESCE(s.t, 0) AS DOUBLE) AS total
FROM (SELECT unnest(range(1, 13)) AS month) m
LEFT JOIN (SELECT month, sum(arrdelay) AS t FROM flights WHERE {yc} GROUP BY month) s
  ON s.month = m.month""",
        "carrier_sum": f"SELECT uniquecarrier, {zsum} AS total FROM flights "
                       f"WHERE year = {year} GROUP BY uniquecarrier",
        "carrier_avg": f"SELECT uniquecarrier, round(avg(CAST(arrdelay AS DOUBLE)), 6) AS avg_delay "
                       f"FROM flights WHERE year = {year} GROUP BY uniquecarrier",
        "span_sum": span,
        "span_count": f"SELECT CAST(count(*) AS BIGINT) AS n FROM ({span}) s",
        "grid_sum": grid(""),
        "grid_sum_first_day": grid(" AND day = 1"),
        "grid_carrier_total": f"SELECT uniquecarrier, sum(total) AS total FROM ({grid('')}) g "
                              f"GROUP BY uniquecarrier",
        "range_sum_open": f"SELECT {zsum} AS total FROM flights WHERE uniquecarrier = '{carrier}' "
                          f"AND flightdate > {lo_hi[0]} AND flightdate < {lo_hi[1]}",
        "range_sum_closed": f"SELECT {zsum} AS total FROM flights WHERE uniquecarrier = '{carrier}' "
                            f"AND flightdate >= {lo_hi[0]} AND flightdate <= {lo_hi[1]}",
        "monthly_range_sums": f"""
SELECT r.range_id, strftime(r.lo, '%Y-%m-%d') AS lo, strftime(r.hi, '%Y-%m-%d') AS hi,
       COALESCE(CAST(sum(f.arrdelay) AS DOUBLE), 0.0) AS total
FROM {_ranges_values(year)}
LEFT JOIN flights f ON f.uniquecarrier = '{carrier}' AND f.flightdate BETWEEN r.lo AND r.hi
GROUP BY r.range_id, r.lo, r.hi""",
        "top_delays": f"SELECT CAST(arrdelay AS FLOAT) AS arrdelay, year, uniquecarrier FROM flights "
                      f"WHERE {yc} ORDER BY arrdelay DESC, {SEQ_SQL} LIMIT {TOP_N}",
        "key_by_delay": f"SELECT CAST(arrdelay AS FLOAT) AS delay, year, uniquecarrier "
                        f"FROM flights WHERE {yc}",
        "limit_per_month": f"""
SELECT year, month, uniquecarrier, flightnum, day, arrdelay
FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY {CLUSTER_ORDER_SQL}) AS rn
      FROM flights WHERE {yc} AND month BETWEEN 1 AND 12) t
WHERE rn <= {LIMIT_PER_MONTH}""",
        "take_first": f"SELECT uniquecarrier, {zsum} AS total FROM flights WHERE year = {year} "
                      f"GROUP BY uniquecarrier ORDER BY uniquecarrier LIMIT 5",
        "clustered_scan": f"""
SELECT year, month, uniquecarrier, flightnum, day, arrdelay, l_orderkey, l_linenumber,
       CAST(row_number() OVER (PARTITION BY year, uniquecarrier, month
                               ORDER BY {CLUSTER_ORDER_SQL}) AS BIGINT) AS pos
FROM flights""",
        "top_per_carrier": f"""
SELECT uniquecarrier, CAST(rank AS INTEGER) AS rank, arrdelay
FROM (SELECT uniquecarrier, arrdelay,
             row_number() OVER (PARTITION BY uniquecarrier ORDER BY arrdelay DESC, {SEQ_SQL}) AS rank
      FROM flights WHERE year = {year}) t
WHERE rank <= {TOP_N}""",
        "coerce_getters": "SELECT TRY_CAST(year AS INTEGER) AS year, TRY_CAST(month AS INTEGER) AS month, "
                          "uniquecarrier, TRY_CAST(arrdelay AS FLOAT) AS arrdelay, l_orderkey, l_linenumber "
                          "FROM flights_raw",
        "typed_load": f"SELECT * REPLACE (strftime(flightdate, '%Y-%m-%d') AS flightdate) FROM "
                      f"(SELECT {_typed_select(V1_SQL, v1_order)}, {SEQ_SQL} "
                      f"FROM flights_raw WHERE {_ok(V1_SQL)}) t",
        "typed_load_ints": f"SELECT {_typed_select(V5_SQL, COLUMNS)}, {SEQ_SQL} "
                           f"FROM flights_raw WHERE {_ok(V5_SQL)}",
        "load_rejects": f"SELECT {SEQ_SQL}, deptime, arrdelay, {_reason(V1_SQL)} AS reject_reason "
                        f"FROM flights_raw WHERE NOT ({_ok(V1_SQL)})",
        "load_rejects_final": f"SELECT {SEQ_SQL}, arrdelay, 'arrdelay' AS reject_reason "
                              f"FROM flights_raw WHERE TRY_CAST(arrdelay AS INTEGER) IS NULL",
        "hhmm_minutes": f"SELECT DISTINCT deptime, {hhmm_sql('deptime')} AS minutes FROM flights_raw",
        "year_fanout": f"SELECT CAST(y.fy AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n, "
                       f"CAST(sum(arrdelay) AS DOUBLE) AS total FROM flights "
                       f"CROSS JOIN (SELECT unnest(range({flo}, {fhi + 1})) AS fy) y GROUP BY y.fy",
        "csv_scan": "SELECT * FROM flights_raw",
        "chain_files": "SELECT * FROM flights_raw UNION ALL SELECT * FROM flights_raw",
        "line_split": f"SELECT {len(COLUMNS) + 5} AS n_fields, year, uniquecarrier, arrdelay, "
                      "l_orderkey, l_linenumber FROM flights_raw",
        "keyed_upsert_day": upsert("year, month, uniquecarrier, flightnum, day"),
        "keyed_upsert_month": upsert("year, month, uniquecarrier, flightnum"),
        "bucketed_upsert_day": upsert("year, month, uniquecarrier, flightnum, day"),
        "keyed_layout_month": upsert("year, month, uniquecarrier, flightnum"),
        "keyed_layout_day": upsert("year, month, uniquecarrier, flightnum, day"),
        "layout_partitioned": "SELECT year, month, CAST(count(*) AS BIGINT) AS n, "
                              "CAST(sum(arrdelay) AS DOUBLE) AS total FROM flights GROUP BY year, month",
        "layout_bucketed": "SELECT uniquecarrier, flightnum, CAST(count(*) AS BIGINT) AS n, "
                           "CAST(sum(arrdelay) AS DOUBLE) AS total FROM flights "
                           "GROUP BY uniquecarrier, flightnum",
        "load_counters": f"SELECT CAST(count(*) FILTER (WHERE {_ok(V5_SQL)}) AS BIGINT) AS loaded, "
                         f"CAST(count(*) FILTER (WHERE NOT ({_ok(V5_SQL)})) AS BIGINT) AS rejected "
                         f"FROM flights_raw",
        "stream_load": f"SELECT {_typed_select(V5_SQL, COLUMNS)}, {SEQ_SQL} "
                       f"FROM flights_raw WHERE {_ok(V5_SQL)}",
        "cached_filter_sum": f"SELECT {zsum} AS total FROM flights WHERE {yc}",
        "cached_span_sum": span,
        "keyed_layout_carrier": f"""
SELECT uniquecarrier, strftime(flightdate, '%Y-%m-%d') AS flightdate, flightnum, deptime, arrdelay
FROM (SELECT *, row_number() OVER (PARTITION BY uniquecarrier, flightdate, flightnum ORDER BY {SEQ_DESC_SQL}) AS rn
      FROM (SELECT {_typed_select(V1_SQL, v1_order)}, {SEQ_SQL} FROM flights_raw WHERE {_ok(V1_SQL)}) t) u
WHERE rn = 1""",
        "keyed_layout_carrier_month": upsert(day_key, "flights_raw"),
        "keyed_layout_carrier_ymd": f"""
SELECT * FROM ({upsert(day_key, "flights_raw")}) t
WHERE uniquecarrier = '{carrier}' AND year = '{year}' AND month = '{month}'
  AND day IN ('5', '10', '15', '20', '25', '30')""",
        "merge_upsert": upsert(day_key),
        "csv_multiline": "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN concat(tailnum, chr(10), "
                         "'seen \"twice\", at ', origin) ELSE tailnum END AS tailnum) FROM flights_raw",
        "load_malformed": f"""
SELECT outcome, reason, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY outcome) AS BIGINT) AS counted
FROM ({outcome}) o GROUP BY outcome, reason""",
        "load_final": f"""
SELECT CAST(y.fy AS INTEGER) AS year, month, day, uniquecarrier, flightnum, CAST(arrdelay AS INTEGER) AS arrdelay,
       l_orderkey, l_linenumber
FROM (SELECT *, row_number() OVER (PARTITION BY uniquecarrier, month, flightnum, day ORDER BY {SEQ_DESC_SQL}) AS rn
      FROM flights_raw WHERE {ok_final}) t
CROSS JOIN (SELECT unnest(range({flo}, {fhi + 1})) AS fy) y WHERE rn = 1""",
        "load_counters_write": f"SELECT CAST({n_years} * count(*) FILTER (WHERE {ok_final}) AS BIGINT) AS loaded, "
                               f"CAST({n_years} * count(*) FILTER (WHERE NOT ({ok_final})) AS BIGINT) AS rejected "
                               f"FROM flights_raw",
        "load_groups": f"""
SELECT CAST(g AS BIGINT) AS load_group, CAST(count(*) FILTER (WHERE {ok_final}) AS BIGINT) AS loaded,
       CAST(count(*) FILTER (WHERE NOT ({ok_final})) AS BIGINT) AS rejected,
       CAST(sum(TRY_CAST(arrdelay AS INTEGER)) AS BIGINT) AS total,
       min(l_orderkey) FILTER (WHERE {ok_final}) AS first_order, max(l_orderkey) FILTER (WHERE {ok_final}) AS last_order
FROM (SELECT *, (row_number() OVER (ORDER BY {SEQ_SQL}) - 1) // {LOAD_BATCH_ROWS} AS g FROM flights_raw) t
GROUP BY g""",
        "span_sum_year": year_span,
        "span_count_year": f"SELECT CAST(count(*) AS BIGINT) AS n FROM ({year_span}) s",
        "cached_span_sum_year": f"SELECT *, count(*) OVER () AS n_runs FROM ({year_span}) s",
    }
    return {k: _q(v) for k, v in q.items()}
