"""One-pass and restartable loads, merges, file skipping, limits, range sums."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystats.operators import ingest, load, measures, ordered, topk, upsert
from delaystats.plans.explain import plan_text
from delaystats.schema import COLUMNS, LAYOUTS, KeyedLayout, all_string_schema
from delaystats.sources import csv as csv_source
from delaystats.sources import layout, skipping
from test_ingest import GOOD, line, write


@pytest.fixture
def three_rows(tmpdir_path):
    short = ",".join(GOOD[c] for c in COLUMNS[:20])
    return write(tmpdir_path, "three.csv", [line(), short, line(flightnum="long") + ",x,y"])


def test_malformed_rows_are_the_same_for_every_query(spark, three_rows, tmpdir_path):
    raw = csv_source.read_flights_csv(spark, three_rows)
    good, bad = ingest.typed_load(raw, "v5")
    assert tuple(ingest.load_counts(raw, "v5").first()) == (1, 2)
    assert (good.count(), bad.count(), len(good.collect()), len(bad.collect())) == (1, 2, 1, 2)
    assert good.select("year").count() == 1 and bad.select("month").distinct().count() == 1
    assert len(raw.where("_corrupt_record is not null").select("tailnum").collect()) == 2
    assert ingest.load_layout(raw, os.path.join(tmpdir_path, "l"), "v5") == {"loaded": 1, "rejected": 2}


@pytest.mark.parametrize("variant", ["v1", "v5", "final"])
def test_one_job_writes_and_counts_both_outcomes(spark, three_rows, tmpdir_path, variant):
    raw = csv_source.read_flights_csv(spark, three_rows)
    path = os.path.join(tmpdir_path, "both")
    by = ("uniquecarrier",) if variant == "v1" else ("year", "month")
    assert load.load_once(raw, path, variant, partition_by=by, cluster_by=("flightnum",)) == {"loaded": 1, "rejected": 2}
    good, bad = ingest.typed_load(raw, variant)
    want = good.collect()
    assert load.read_loaded(spark, path, good.schema).select(*good.columns).collect() == want
    kept = load.read_rejected(spark, path, all_string_schema())
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, bad.collect()))
    # clean and empty inputs
    clean = os.path.join(tmpdir_path, "clean")
    assert load.load_once(raw.where("_corrupt_record is null"), clean, variant, by, ("flightnum",))["rejected"] == 0
    assert load.read_rejected(spark, clean, all_string_schema()).collect() == []


def raw_rows(spark, n):
    cols = [F.lit(GOOD[c]).alias(c) for c in COLUMNS if c not in ("flightnum", "arrdelay")]
    return spark.range(n).select(*cols, F.col("id").cast("string").alias("flightnum"), F.when(
        F.col("id") % 10 == 0, "NA").otherwise((F.col("id") % 50).cast("string")).alias("arrdelay"),
        F.col("id").alias("seq")).repartition(5)


def test_killed_group_load_resumes(spark, tmpdir_path):
    raw, path = raw_rows(spark, 1050), os.path.join(tmpdir_path, "g")
    ledger = load.load_groups(raw, path, ["seq"], group_rows=100, steps=4, stop_after=2)
    done = ledger.count()
    assert 0 < done < 11
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/groups/**/*.parquet", recursive=True)}
    # a run that died after it wrote a step's groups and before its ledger entry
    os.makedirs(f"{path}/groups/load_group=9/load_status=loaded")
    raw.limit(3).selectExpr("cast(arrdelay as string) arrdelay").write.mode("overwrite").parquet(
        f"{path}/groups/load_group=9/load_status=loaded")
    ledger = load.load_groups(raw, path, ["seq"], group_rows=100, steps=4)
    rows = {r[load.GROUP]: (r["loaded"], r["rejected"]) for r in ledger.collect()}
    assert rows == {**{g: (90, 10) for g in range(10)}, 10: (45, 5)}
    assert all(os.path.getmtime(f) == t for f, t in files.items())         # finished groups are left alone
    stored = spark.read.parquet(f"{path}/groups")
    assert stored.count() == 1050 and stored.where(f"load_group != seq div 100").count() == 0
    before = sorted(glob.glob(f"{path}/groups/**/*.parquet", recursive=True))
    load.load_groups(raw, path, ["seq"], group_rows=100, steps=4)          # nothing to do
    assert sorted(glob.glob(f"{path}/groups/**/*.parquet", recursive=True)) == before


TABLE = KeyedLayout("t", ("year", "month"), ("k",))
SCHEMA = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
                       T.StructField("k", T.LongType()), T.StructField("v", T.StringType()),
                       T.StructField("seq", T.LongType())])


def test_merge_rewrites_touched_directories_only(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "m")
    old = spark.range(120).selectExpr("2000 + cast(id % 2 as int) year", "if(id % 5 = 4, null, cast(id % 5 as int)) month",
                                      "id div 20 k", "'old' v", "id seq")
    layout.write_keyed(old, TABLE, path, ["seq"])
    stored = {r[:3]: tuple(r) for r in layout.read_layout(spark, path, SCHEMA).select(*SCHEMA.names).collect()}

    def files():
        return {f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}
    before = files()
    batch = [(2000, 2, 0, "new", 500), (2000, 2, 1, "stale", -1), (2000, None, 3, "null month", 501),
             (2005, 1, 9, "added", 502), (2000, 2, 0, "newer", 503)]
    assert upsert.merge_into(path, TABLE, spark.createDataFrame(batch, SCHEMA), ["seq"], SCHEMA) == 3
    for row in sorted(batch, key=lambda r: r[-1]):
        if row[:3] not in stored or stored[row[:3]][-1] < row[-1]:
            stored[row[:3]] = row
    got = layout.read_layout(spark, path, SCHEMA).select(*SCHEMA.names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, stored.values()))
    gone = before - files()
    assert gone and all("year=2000/month=2" in f or "year=2000/month=__HIVE" in f for f in gone)
    plan = plan_text(layout.read_layout(spark, path, SCHEMA).where(F.to_json(F.struct("year", "month")).isin(["{}"])))
    assert "PartitionFilters: [" in plan and "StructsToJson" in plan.split("PartitionFilters:")[1]
    assert upsert.merge_into(path, TABLE, spark.createDataFrame([], SCHEMA), ["seq"], SCHEMA) == 0


def test_lookup_opens_few_files(spark, tmpdir_path):
    path, index = os.path.join(tmpdir_path, "s"), os.path.join(tmpdir_path, "i")
    table = KeyedLayout("c", ("c",), ("d", "n"))
    rows = spark.range(20_000).selectExpr("concat('c', id % 3) c", "cast(id % 1000 as string) d", "id n")
    schema = T.StructType([T.StructField("c", T.StringType()), T.StructField("d", T.StringType()),
                           T.StructField("n", T.LongType())])
    skipping.write_cut(rows, path, table, files=30)
    skipping.build_index(spark, path, ("c",), ("c", "d"), index, schema)
    files = len(glob.glob(f"{path}/**/*.parquet", recursive=True))
    keys = [("c1", "7"), ("c2", "500"), ("c9", "7"), ("c1", "nothing")]
    got = skipping.lookup(spark, path, index, ("c",), ("c", "d"), keys, schema)
    assert files >= 25 and 1 <= len(got.inputFiles()) <= 4
    want = rows.where("(c = 'c1' and d = '7') or (c = 'c2' and d = '500')").collect()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want)) and want
    assert skipping.lookup(spark, path, index, ("c",), ("c", "d"), [("c9", "7")], schema).collect() == []
    everything = skipping.lookup(spark, path, index, ("c",), ("c", "d"),
                                 [tuple(r) for r in rows.select("c", "d").distinct().collect()], schema)
    assert everything.count() == 20_000


@pytest.mark.parametrize("n", [5000, 1001])
def test_limits_above_the_planners_bound(spark, n):
    df = spark.range(30_000).selectExpr("if(id % 4 = 0, 'b', 'hot') g", "id % 977 v", "id")
    got = topk.limit_per_group(df, ["g"], [F.col("v").desc(), "id"], n, rank_name="rank")
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r["g"], -r["v"], r["id"])):
        want.setdefault(r["g"], []).append(r["id"])
    rows = sorted(got.collect(), key=lambda r: (r["g"], r["rank"]))
    assert [(r["g"], r["rank"], r["id"]) for r in rows] == [
        (g, i, x) for g in sorted(want) for i, x in enumerate(want[g][:n], 1)]
    assert "_salt" not in got.columns and plan_text(got).count("hashpartitioning") >= 2


def test_many_nested_ranges(spark):
    days = [(dt.date(1997, 1, 1) + dt.timedelta(days=i)) for i in range(0, 360, 3)]
    rows = [(d.year, d.month, "WN", d, 2**54 + i) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "year int, month int, uniquecarrier string, flightdate date, arrdelay long")
    ranges = [(dt.date(1996, 12, 1) + dt.timedelta(days=i % 150), dt.date(1998, 1, 1) - dt.timedelta(days=i % 211))
              for i in range(100_000)]
    got = measures.range_sums(spark, df, "WN", ranges)
    assert "_total" not in got.columns
    sums = {r["range_id"]: r["total"] for r in got.collect()}
    assert len(sums) == len(ranges)
    for i in (0, 1, 77, 4321, 99_999):
        lo, hi = ranges[i]
        assert sums[i + 1] == float(sum(v for _, _, _, d, v in rows if lo <= d <= hi))


def test_keyed_write_deals_rows_once(spark, tmpdir_path, monkeypatch):
    from delaystats.sources import layout
    monkeypatch.setattr(layout, "TASK_ROWS", 500)
    table = KeyedLayout("t", ("p", "q"), ("k",))
    rows = spark.range(6000).selectExpr("if(id % 3 = 0, cast(id % 7 as int), 1) p", "if(id % 10 = 9, null, 'x') q",
                                        "id % 4000 k", "id seq", "concat('v', id) v")
    dealt = layout._deal(rows, table)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2500 and sum(sizes) == 6000
    path = os.path.join(tmpdir_path, "once")
    layout.write_keyed(rows, table, path, ["seq"])
    got = layout.read_layout(spark, path, rows.schema)
    want = upsert.upsert(rows, table.primary_key, ["seq"])
    assert sorted(map(str, got.select(rows.columns).collect())) == sorted(map(str, want.collect()))
    assert len(glob.glob(f"{path}/p=1/q=x/*.parquet")) > 1
    often = rows.withColumn("k", F.col("k") % 5)        # half of the rows and more are written over
    assert layout._deal(often, table) is None and layout._deal(rows.where("false"), table) is None
    layout.write_keyed(often, table, path, ["seq"])
    assert layout.read_layout(spark, path, rows.schema).count() == often.select("p", "q", "k").distinct().count()


def test_write_settings_hold_for_the_write_only(spark):
    from delaystats.session import write_settings
    names = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n) for n in names]
    with write_settings(spark):
        with write_settings(spark, split=False):
            assert spark.conf.get(names[0]) == "8000"
        assert [spark.conf.get(n) for n in names] == ["8000", str(16 << 20)]
    assert [spark.conf.get(n) for n in names] == before


def test_buckets_fit_a_task():
    from delaystats.sources import layout
    assert layout.BUCKET_BYTES <= 32 << 20


def test_cut_files_hold_the_latest_rows(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(skipping, "TASK_ROWS", 300)
    table = KeyedLayout("c", ("c",), ("d",))
    rows = spark.range(6000).selectExpr("concat('c', id % 3) c", "cast(id % 4001 as string) d", "id seq")
    path = os.path.join(tmpdir_path, "cut")
    skipping.write_cut(rows, path, table, files=4, seq=["seq"])
    got = spark.read.schema(rows.schema).parquet(path)
    want = upsert.upsert(rows, table.primary_key, ["seq"])
    assert sorted(map(tuple, got.select(rows.columns).collect())) == sorted(map(tuple, want.collect()))
    assert len(glob.glob(f"{path}/**/*.parquet", recursive=True)) >= 18


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    at = [files.apply(i) for i in range(files.size())]
    return sum(f.length() for f in at if f.getName().startswith("shuffle_") and f.getName().endswith(".data"))


def test_writes_leave_no_shuffle_files(spark, tmpdir_path):
    rows = spark.range(100_000).selectExpr("cast(id % 3 as int) year", "1 month", "cast(id as string) k")
    before = shuffle_bytes(spark)
    layout.write_partitioned(rows, os.path.join(tmpdir_path, "w"), cluster_by=("k",))
    assert shuffle_bytes(spark) - before < 50_000       # 753 781 when they stayed


@pytest.mark.parametrize("same", [1, 7, 700])
def test_groups_have_their_size_where_keys_repeat(spark, tmpdir_path, same):
    raw, path = raw_rows(spark, 1050), os.path.join(tmpdir_path, "t")
    raw = raw.withColumn("id", F.col("seq")).withColumn("seq", F.when(F.col("id") >= 30, F.floor((F.col("id") - 30) / same)))
    ledger = load.load_groups(raw, path, ["seq"], group_rows=50, steps=6)
    assert {r[load.GROUP]: r["loaded"] + r["rejected"] for r in ledger.collect()} == {g: 50 for g in range(21)}
    rows = spark.read.parquet(f"{path}/groups").select(
        load.GROUP, F.coalesce("id", "rejected_row.id").alias("id"), F.coalesce("seq", "rejected_row.seq").alias("seq")).collect()
    assert sorted(r["id"] for r in rows) == list(range(1050))
    by_group = [r["seq"] for r in sorted(rows, key=lambda r: (r[load.GROUP], r["seq"] is not None, r["seq"] or 0))]
    assert by_group == sorted(by_group, key=lambda s: (s is not None, s or 0))
    assert "Exchange" not in plan_text(ordered.parts_at(spark.range(9000).selectExpr("id v", "-id seq"), ["seq"], [5, 2000]))


FINAL_SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c in ("year", "arrdelay") else T.StringType())
                             for c in COLUMNS] + [T.StructField("seq", T.LongType())])


@pytest.mark.parametrize("flights", [40, 100_000])     # written over and over, or nearly once
def test_final_load_in_steps(spark, tmpdir_path, monkeypatch, flights):
    monkeypatch.setattr(layout, "STEP_ROWS", 300)
    raw = raw_rows(spark, 2400).withColumns({
        "month": F.expr("if(seq % 13 = 0, null, cast(seq % 13 as string))"), "flightnum": (F.col("seq") * 7 % flights).cast("string"),
        "uniquecarrier": F.expr("if(seq % 5 = 0, 'WN', 'AA')"), "day": F.lit("1")})
    path, staged = os.path.join(tmpdir_path, "f"), os.path.join(tmpdir_path, "s")
    modes, plain = [], layout.write_partitioned

    def seen(df, to, **options):
        assert options["dealt"]
        modes.append((to == path, options.get("mode")))
        return plain(df, to, **options)
    monkeypatch.setattr(load, "write_partitioned", seen)
    counts = load.load_final(raw, path, staged, LAYOUTS["by_carrier_month"], ["seq"], FINAL_SCHEMA, (2007, 2009))
    assert counts == {"loaded": 2160 * 3, "rejected": 240 * 3}
    assert [m for final, m in modes if final][:2] == ["overwrite", "append"] and len(modes) > 4
    want = {}
    for r in raw.where("arrdelay != 'NA'").orderBy("seq").collect():
        for year in (2007, 2008, 2009):
            want[year, r["uniquecarrier"], r["month"], r["flightnum"], r["day"]] = (r["seq"], int(r["arrdelay"]), r["tailnum"])
    got = layout.read_layout(spark, path, FINAL_SCHEMA).collect()
    assert len(got) == len(want) and want == {
        (r["year"], r["uniquecarrier"], r["month"], r["flightnum"], r["day"]): (r["seq"], r["arrdelay"], r["tailnum"]) for r in got}


def test_steps_have_all_rows_once(spark, monkeypatch):
    monkeypatch.setattr(layout, "STEP_ROWS", 100)
    df = spark.range(1000).selectExpr("if(id % 7 = 0, null, cast(id % 7 as int)) a", "id % 3 b", "id")
    steps = layout.in_steps(df, ["a", "b"])
    assert 2 < len(steps) <= layout.STEPS
    keys = [{(r["a"], r["b"]) for r in s.collect()} for s in steps]
    assert sorted(r["id"] for s in steps for r in s.collect()) == list(range(1000))
    assert sum(map(len, keys)) == len(set().union(*keys)) == 21
    assert len(layout.in_steps(df.limit(90), ["a"])) == len(layout.in_steps(df.where("false"), ["a"])) == 1


@pytest.fixture
def small_sf(spark, tmpdir_path):
    rows = spark.range(4000).selectExpr(
        "id % 900 l_orderkey", "id % 700 l_partkey", "id % 60 l_suppkey", "cast(1 + id % 7 as int) l_linenumber",
        "cast(id % 50 as double) l_quantity", "cast(id as double) l_extendedprice", "if(id % 3 = 0, 'R', 'N') l_returnflag",
        "if(id % 101 = 0, null, timestamp'1997-01-01 00:00:00' + make_dt_interval(cast(id % 400 as int))) l_shipdate")
    rows.write.parquet(os.path.join(tmpdir_path, "lineitem.parquet"))
    return tmpdir_path


def test_load_counters_write_keeps_no_shuffle(spark, small_sf):
    from delaystats.plans import catalog
    before = shuffle_bytes(spark)
    counts = catalog.load_counters_write(spark, small_sf).first()
    assert shuffle_bytes(spark) - before < 100_000      # 1 894 810 when they stayed
    bad = len([i for i in range(4000) if i % 7 == 6])
    assert tuple(counts) == (5 * (4000 - bad), 5 * bad)


def test_store_and_buckets_are_written_in_steps(spark, small_sf, monkeypatch):
    from delaystats.plans import catalog
    from delaystats.sources import testdata
    names = testdata.STORE_SCHEMA.fieldNames()
    want = testdata.typed_flights(testdata.flights_raw(spark, small_sf)).select(names)
    monkeypatch.setattr(layout, "STEP_ROWS", 500)
    before = shuffle_bytes(spark)
    stored = testdata.flight_store(spark, small_sf)
    cut = catalog.bucketed(spark, small_sf)
    assert shuffle_bytes(spark) - before < 100_000
    path = catalog.bucketed_table(spark, small_sf)[1]
    files = len(glob.glob(f"{path.removeprefix('file:')}/*.parquet"))
    assert catalog.BUCKETS * 3 < files <= catalog.BUCKETS * layout.STEPS
    rows = sorted(map(str, want.collect()))
    assert rows == sorted(map(str, stored.select(names).collect())) == sorted(map(str, cut.select(names).collect()))
    assert "Exchange" not in plan_text(catalog.bucketed_upsert_day(spark, small_sf))
    got = catalog.bucketed_upsert_day(spark, small_sf).collect()
    assert sorted(map(str, got)) == sorted(map(str, catalog.QUERIES["keyed_upsert_day"](spark, small_sf).collect()))
