"""Load path on hand-made CSVs (FIXTURES.md section 4)."""

import os

import pytest

from delaystats.operators import ingest
from delaystats.schema import COLUMNS
from delaystats.sources import csv as csv_source

GOOD = dict(year="2007", month="1", day="5", dayofweek="5", deptime="905", crsdeptime="900",
            arrtime="1130", crsarrtime="1120", uniquecarrier="WN", flightnum="100", tailnum="N1",
            actualelapsedtime="145", crselapsedtime="140", airtime="120", arrdelay="10",
            depdelay="5", origin="LAX", dest="SFO", distance="337", taxiin="4", taxiout="10",
            cancelled="0", cancellationcode="", diverted="0", carrierdelay="0", weatherdelay="0",
            nasdelay="0", securitydelay="0", lateaircraftdelay="0")
HEADER = ",".join(COLUMNS)


def line(**over):
    row = {**GOOD, **over}
    return ",".join(row[c] for c in COLUMNS)


def write(folder, name, lines, header=True):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        if header:
            f.write(HEADER + "\n")
        for ln in lines:
            f.write(ln + "\n")
    return path


def test_chain_two_files_skips_each_header(spark, tmpdir_path):
    a = write(tmpdir_path, "good_a.csv", [line(flightnum=str(i)) for i in range(3)])
    b = write(tmpdir_path, "good_b.csv", [line(flightnum=str(10 + i)) for i in range(3)])
    one_scan = csv_source.read_flights_csv(spark, [a, b])
    chained = csv_source.chain([csv_source.read_flights_csv(spark, p) for p in (a, b)])
    for df in (one_scan, chained):
        rows = df.collect()
        assert len(rows) == 6
        assert all(r["year"] == "2007" for r in rows)
    twice = csv_source.chain([csv_source.read_flights_csv(spark, a)] * 2)
    assert twice.count() == 6


def test_quoted_field(spark, tmpdir_path):
    p = write(tmpdir_path, "quoted.csv", [line(tailnum='"Smith, J"')])
    row = csv_source.read_flights_csv(spark, p).first()
    assert row["tailnum"] == "Smith, J" and row["lateaircraftdelay"] == "0"
    fields = csv_source.read_split_lines(spark, p, HEADER).first()["fields"]
    assert len(fields) == 30


def test_trailing_empties(spark, tmpdir_path):
    p = write(tmpdir_path, "trailing.csv", [line(securitydelay="", lateaircraftdelay="")])
    row = csv_source.read_flights_csv(spark, p).first()
    assert row["securitydelay"] == "" and row["lateaircraftdelay"] == ""
    assert row["cancellationcode"] == ""
    fields = csv_source.read_split_lines(spark, p, HEADER).first()["fields"]
    assert len(fields) == 27


def test_split_edge_lines(spark, tmpdir_path):
    p = write(tmpdir_path, "edges.txt", ["a,b,,", ",,,", "", "x"], header=False)
    got = [r["fields"] for r in csv_source.read_split_lines(spark, p).collect()]
    assert sorted(map(tuple, got)) == sorted([("a", "b"), (), ("",), ("x",)])


BAD_ROWS = {
    "arrdelay_na": (dict(arrdelay="NA"), "arrdelay", "arrdelay"),
    "month_x": (dict(month="x"), "flightdate", "month"),
    "feb_30": (dict(month="2", day="30"), "flightdate", None),
    "dep_2460": (dict(deptime="2460"), "deptime", None),
    "dep_2400": (dict(deptime="2400"), "deptime", None),
    "dep_905": (dict(deptime="905"), None, None),
    "dep_55": (dict(deptime="55"), None, None),
    "dep_na": (dict(deptime="NA"), "deptime", None),
}


@pytest.fixture
def bad_csv(tmpdir_path):
    lines = [line(flightnum=name, **over) for name, (over, _, _) in BAD_ROWS.items()]
    short = {**GOOD, "flightnum": "short"}
    lines.append(",".join(short[c] for c in COLUMNS[:20]))                # short row
    lines.append(line(flightnum="long") + ",extra1,extra2")               # long row
    return write(tmpdir_path, "bad.csv", lines)


@pytest.mark.parametrize("variant", ["v1", "v5"])
def test_rejects_are_kept_with_reasons(spark, bad_csv, variant):
    raw = csv_source.read_flights_csv(spark, bad_csv)
    good, bad = ingest.typed_load(raw, variant)
    good_rows, bad_rows = good.collect(), bad.collect()
    assert len(good_rows) + len(bad_rows) == raw.count() == len(BAD_ROWS) + 2
    reasons = {r["flightnum"]: r[ingest.REASON] for r in bad_rows}
    col = 1 if variant == "v1" else 2
    for name, spec in BAD_ROWS.items():
        assert reasons.get(name) == spec[col], name
    assert reasons["short"] == reasons["long"] == "shape"


def test_v1_times_are_left_padded_minutes(spark, bad_csv):
    raw = csv_source.read_flights_csv(spark, bad_csv)
    good, _ = ingest.typed_load(raw, "v1")
    got = {r["flightnum"]: r["deptime"] for r in good.collect()}
    assert got["dep_905"] == 545 and got["dep_55"] == 55
    assert len(good.columns) == 27


def test_load_layout_counts_during_write(spark, bad_csv, tmpdir_path):
    raw = csv_source.read_flights_csv(spark, bad_csv)
    out, rej = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "rejects")
    counts = ingest.load_layout(raw, out, "v5", rejects_path=rej,
                                cluster_by=("uniquecarrier", "flightnum"))
    n_bad = sum(spec[2] is not None for spec in BAD_ROWS.values()) + 2   # + short, long rows
    assert counts == {"loaded": len(BAD_ROWS) + 2 - n_bad, "rejected": n_bad}
    assert spark.read.parquet(out).count() == counts["loaded"]
    assert spark.read.parquet(rej).count() == counts["rejected"]

    # the sampling (range) writer path gives the same counts
    out2, rej2 = os.path.join(tmpdir_path, "out2"), os.path.join(tmpdir_path, "rejects2")
    counts2 = ingest.load_layout(raw, out2, "v5", rejects_path=rej2, num_partitions=3,
                                 cluster_by=("uniquecarrier", "flightnum"))
    assert counts2 == counts
    assert spark.read.parquet(out2).count() == counts["loaded"]


def test_year_fanout(spark, tmpdir_path):
    p = write(tmpdir_path, "good_a.csv", [line(flightnum=str(i)) for i in range(3)])
    good, _ = ingest.typed_load(csv_source.read_flights_csv(spark, p), "v5")
    out = ingest.year_fanout(good)
    assert out.count() == 15
    assert sorted({r["year"] for r in out.collect()}) == [2007, 2008, 2009, 2010, 2011]
    assert out.columns == good.columns


def test_hot_month_is_split_across_writers(spark, tmpdir_path):
    """A month holding most rows is written by several tasks, not one."""
    from pyspark.sql import functions as F
    from delaystats.sources.layout import write_partitioned
    n = 200_000
    df = (spark.range(n).select(
        F.when(F.col("id") % 10 < 8, F.lit(7)).otherwise((F.col("id") % 12 + 1).cast("int")).alias("month"),
        F.lit(1997).alias("year"), (F.col("id") % 20).cast("string").alias("uniquecarrier"),
        (F.col("id") % 500).cast("string").alias("flightnum"), (F.col("id") % 28 + 1).alias("day"),
        F.col("id")))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        out = os.path.join(tmpdir_path, "hot")
        write_partitioned(df, out, mode="overwrite")
    finally:
        spark.conf.set(key, old)
    hot = os.path.join(out, "year=1997", "month=7")
    assert len([f for f in os.listdir(hot) if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(out).count() == n


def test_load_groups_cap_rows_per_file(spark, tmpdir_path):
    from pyspark.sql import functions as F
    from delaystats.schema import LOAD_BATCH_ROWS
    from delaystats.sources.layout import write_partitioned
    n = 2 * LOAD_BATCH_ROWS + 10
    df = spark.range(n).select(F.lit(2007).alias("year"), F.lit(1).alias("month"),
                               F.lit("WN").alias("uniquecarrier"),
                               F.col("id").cast("string").alias("flightnum"), F.lit(1).alias("day"))
    out = os.path.join(tmpdir_path, "groups")
    write_partitioned(df, out, max_records_per_file=LOAD_BATCH_ROWS, num_partitions=1)
    files = [f for f in os.listdir(os.path.join(out, "year=2007", "month=1")) if f.endswith(".parquet")]
    assert len(files) == 3
    assert spark.read.parquet(out).count() == n



def test_try_int_equals_try_cast(spark):
    from pyspark.sql import functions as F
    from delaystats.functions import try_int
    vals = ["12", "-5", "+7", " 12 ", "NA", "", "2007.0", "99999999999", "2147483647",
            "2147483648", "1e3", "\t3", "0x1F", "-", "+", "007", None, "１２", "n/a"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    rows = df.select("s", try_int("s").alias("a"), F.col("s").try_cast("int").alias("b")).collect()
    assert [r["s"] for r in rows if r["a"] != r["b"]] == []
