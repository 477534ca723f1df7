"""Physical plans: pruning, pushdown, no needless shuffles, bounded broadcasts."""

import __spark_entry__ as entry
from conftest import SF_SMALL
from delaystats.plans.explain import plan_text
from delaystats.sources import layout
from delaystats.sources.testdata import STORE_SCHEMA, store_path

Q = entry.queries()


def plan(spark, name):
    return plan_text(Q[name](spark, SF_SMALL), "formatted")


def test_key_equalities_prune_partitions(spark):
    p = plan(spark, "partition_sum")
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p and "(month#" in p
    assert "PushedFilters: [IsNotNull(uniquecarrier), EqualTo(uniquecarrier,WN)]" in p
    assert "ReadSchema: struct<uniquecarrier:string,arrdelay:int>" in p


def test_date_range_prunes_partitions(spark):
    p = plan(spark, "range_sum_open")
    assert "PartitionFilters: [" in p and "* 100)" in p


def test_native_count_is_pushed_to_footers(spark):
    p = layout.count_plan(spark, store_path(spark, SF_SMALL), STORE_SCHEMA)
    assert "PushedAggregation: [COUNT(*)]" in p
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") in ("false", None)


def test_top_k_is_take_ordered(spark):
    p = plan(spark, "top_delays")
    assert "TakeOrderedAndProject" in p
    assert "Exchange rangepartitioning" not in p


def test_limits_use_window_group_limit(spark):
    for name in ("limit_per_month", "keyed_upsert_day", "top_per_carrier"):
        assert "WindowGroupLimit" in plan(spark, name), name


def test_bucketed_layout_needs_no_shuffle(spark):
    for name in ("layout_bucketed", "bucketed_upsert_day"):
        assert "Exchange" not in plan(spark, name), name


def test_grid_and_ranges_broadcast_bounded_sides(spark):
    for name in ("grid_sum", "monthly_range_sums"):
        p = plan(spark, name)
        assert "BroadcastHashJoin" in p, name
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_no_python_udf_in_measures(spark):
    for name in ("partition_sum", "split_sum", "carrier_sum", "grid_sum", "typed_load"):
        p = plan(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_hot_bucket_falls_back_to_split_scan(spark):
    from delaystats.plans import catalog
    name, path = catalog.bucketed_table(spark, SF_SMALL)
    sizes = layout.bucket_bytes(spark, path).collect()
    assert len(sizes) == catalog.BUCKETS and all(r["bytes"] > 0 for r in sizes)
    normal = layout.read_bucketed(spark, name, path, catalog.BUCKETS)
    forced = layout.read_bucketed(spark, name, path, catalog.BUCKETS, factor=0.5, floor_bytes=0)
    agg = lambda df: df.groupBy("uniquecarrier", "flightnum").count()
    assert "Exchange" not in plan_text(agg(normal))
    assert "Exchange" in plan_text(agg(forced)) and "hashpartitioning" in plan_text(agg(forced))
    assert sorted(map(tuple, agg(normal).collect())) == sorted(map(tuple, agg(forced).collect()))


def test_scale_conf_sizes_partitions():
    from delaystats.session import scale_conf
    big = scale_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    small = scale_conf(10 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.enabled"] == "true"
