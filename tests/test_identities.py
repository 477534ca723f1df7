"""Identities the reference's logs show between its queries."""

import __spark_entry__ as entry
from conftest import SF_SMALL

Q = entry.queries()


def one(spark, name, sf=SF_SMALL):
    return Q[name](spark, sf).collect()


def test_native_count_equals_scan_count(spark):
    assert one(spark, "native_count")[0]["n"] == one(spark, "scan_count")[0]["n"] > 0


def test_filter_sum_equals_split_total(spark):
    total = one(spark, "filter_sum")[0]["total"]
    split = one(spark, "split_sum")
    rollup = [r["total"] for r in split if r["month"] is None]
    months = [r["total"] for r in split if r["month"] is not None]
    assert rollup == [total]
    assert sum(months) == total
    assert sum(r["total"] for r in one(spark, "sql_month_sum")) == total


def test_grid_cell_equals_partition_sum(spark):
    cell = [r["total"] for r in one(spark, "grid_sum") if r["uniquecarrier"] == "WN" and r["month"] == 1]
    assert cell == [one(spark, "partition_sum")[0]["total"]]


def test_grid_has_every_cell(spark):
    for name in ("grid_sum", "grid_sum_first_day"):
        rows = one(spark, name)
        assert len(rows) == 240
        assert len({(r["uniquecarrier"], r["month"]) for r in rows}) == 240


def test_grid_totals_equal_carrier_sums(spark):
    grid = {r["uniquecarrier"]: r["total"] for r in one(spark, "grid_carrier_total")}
    direct = {r["uniquecarrier"]: r["total"] for r in one(spark, "carrier_sum")}
    assert {k: grid.get(k, 0.0) for k in direct} == direct
    assert all(v == 0.0 for k, v in grid.items() if k not in direct)


def test_cached_equals_uncached(spark):
    assert one(spark, "cached_filter_sum") == one(spark, "filter_sum")
    a = sorted(tuple(r) for r in one(spark, "cached_span_sum"))
    b = sorted(tuple(r) for r in one(spark, "span_sum"))
    assert a == b


def test_runs_at_least_keys(spark):
    runs = one(spark, "span_sum")
    assert one(spark, "span_count")[0]["n"] == len(runs)
    keys = {(r["year"], r["month"], r["uniquecarrier"]) for r in runs}
    assert len(runs) >= len(keys)
    assert sum(r["total"] for r in runs) == sum(r["total"] for r in one(spark, "layout_partitioned"))


def test_fanout_count_divisible_by_five(spark):
    rows = one(spark, "year_fanout")
    n = one(spark, "scan_count")[0]["n"]
    assert sorted(r["year"] for r in rows) == [2007, 2008, 2009, 2010, 2011]
    assert {r["n"] for r in rows} == {n}
    assert sum(r["n"] for r in rows) % 5 == 0


def test_open_range_within_closed_range(spark):
    from delaystats.operators import measures
    from delaystats.sources.testdata import flight_store
    df = flight_store(spark, SF_SMALL)
    lo, hi = "1997-01-01", "1997-01-31"
    d = df.where("uniquecarrier = 'WN'")
    n_open = d.where(f"flightdate > '{lo}' AND flightdate < '{hi}'").count()
    n_closed = d.where(f"flightdate >= '{lo}' AND flightdate <= '{hi}'").count()
    assert n_open <= n_closed
    closed = measures.date_range_sum(df, "WN", lo, hi, closed=True).first()["total"]
    jan = [r["total"] for r in one(spark, "monthly_range_sums") if r["range_id"] == 1]
    assert jan == [closed]


def test_upsert_is_one_row_per_key(spark):
    for name, key in (("keyed_upsert_day", ("year", "month", "uniquecarrier", "flightnum", "day")),
                      ("keyed_upsert_month", ("year", "month", "uniquecarrier", "flightnum"))):
        rows = one(spark, name)
        assert len({tuple(r[k] for k in key) for r in rows}) == len(rows)
    assert sorted(map(tuple, one(spark, "bucketed_upsert_day"))) == \
        sorted(map(tuple, one(spark, "keyed_upsert_day")))


def test_load_counters_add_up(spark):
    c = one(spark, "load_counters")[0]
    assert c["loaded"] == one(spark, "scan_count")[0]["n"]
    assert c["loaded"] + c["rejected"] == len(one(spark, "coerce_getters"))


def test_every_key_variant_writes_one_row_per_key(spark, tmpdir_path):
    import os
    from delaystats.schema import LAYOUTS
    from delaystats.sources import layout
    from delaystats.sources.testdata import SEQ, STORE_SCHEMA, flight_store
    store = flight_store(spark, SF_SMALL)
    for name in ("by_carrier", "by_month", "by_month_day", "by_carrier_month"):
        t = LAYOUTS[name]
        path = os.path.join(tmpdir_path, name)
        layout.write_keyed(store, t, path, SEQ)
        back = layout.read_layout(spark, path, STORE_SCHEMA)
        keys = back.select(*t.primary_key)
        assert keys.count() == keys.distinct().count() == store.select(*t.primary_key).distinct().count()
        assert {d for d in os.listdir(path) if "=" in d} == \
            {f"{t.partition[0]}={r[0]}" for r in store.select(t.partition[0]).distinct().collect()}


def test_split_sums_zero_fill_empty_selection(spark):
    """No matching rows: every month is 0.0 and so is the total."""
    from delaystats.operators import measures
    from delaystats.sources.testdata import flight_store
    df = flight_store(spark, SF_SMALL)
    rows = measures.split_sum(df, 1900, "WN").collect()
    assert len(rows) == 13 and all(r["total"] == 0.0 for r in rows)
    assert sum(r["month"] is None for r in rows) == 1
    sql = measures.sql_month_sum(spark, df, 1900, "WN").collect()
    assert sorted(r["month"] for r in sql) == list(range(1, 13))
    assert all(r["total"] == 0.0 for r in sql)

