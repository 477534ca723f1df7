"""Changed inputs, wide range lists and bucket counts."""

import datetime as dt
import shutil

from pyspark.sql import functions as F

from delaystats.operators import measures
from delaystats.plans import catalog
from delaystats.sources import layout
from conftest import SF_SMALL


def test_appended_rows_reach_every_staged_query(spark, tmp_path):
    sf = tmp_path / "sf"
    (sf / "lineitem.parquet").mkdir(parents=True)
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", sf / "lineitem.parquet" / "a.parquet")
    names = ("csv_scan", "line_split", "scan_count", "native_count", "layout_bucketed", "cached_filter_sum",
             "cached_span_sum")

    def seen():
        return {n: sorted(map(str, catalog.QUERIES[n](spark, str(sf)).collect())) for n in names}

    before = seen()
    more = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0")
    more.withColumn("l_orderkey", F.col("l_orderkey") + 10**6).write.parquet(str(tmp_path / "more"))
    for i, f in enumerate(sorted((tmp_path / "more").glob("*.parquet"))):
        shutil.copy(f, sf / "lineitem.parquet" / f"b{i}.parquet")
    after = seen()
    for n in names:
        assert before[n] != after[n], n


def test_range_lists_of_any_size(spark):
    rows = [(y, m, d, "WN", dt.date(y, m, d), 2) for y in (1, 999, 1997, 9999) for m in (1, 12) for d in (1, 31)]
    df = spark.createDataFrame(rows, "year int, month int, day int, uniquecarrier string, flightdate date, arrdelay int")
    first, last = dt.date(1, 1, 1), dt.date(9999, 12, 31)
    got = {r["range_id"]: r["total"] for r in measures.range_sums(
        spark, df, "WN", [(first, last), (last, first), (dt.date(1997, 1, 2), dt.date(1997, 12, 30))]).collect()}
    assert got == {1: 32.0, 2: 0.0, 3: 4.0}
    days = [(dt.date(1997, 1, 1) + dt.timedelta(days=i),) * 2 for i in range(366)]
    got = [r["total"] for r in measures.range_sums(spark, df, "WN", days).orderBy("range_id").collect()]
    assert sum(got) == 8.0 and len(got) == 366
    assert measures.range_sums(spark, df, "WN", []).collect() == []
    assert measures.date_range_sum(df, "WN", first, last, closed=True).first()["total"] == 32.0


def test_bucket_count_follows_the_bytes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100_000).write.parquet(path)
    assert layout.bucket_count(spark, path) == 8
    monkeypatch.setattr(layout, "BUCKET_BYTES", 20_000)
    assert layout.bucket_count(spark, path) == -(-layout.stored_bytes(spark, path) // 10_000) > 8


def test_footer_count_leaves_the_session_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10)
    df.write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    count = layout.native_count(spark, path, df.schema)
    assert "PushedAggregation: [COUNT(*)]" in layout.count_plan(spark, path, df.schema)
    assert count.first()["n"] == 10 and spark.conf.get("spark.sql.sources.useV1SourceList") == before
