"""Incremental load: batches, replay safety, last write wins on read."""

import os

from delaystats.schema import KEY_BY_DAY
from delaystats.sources.testdata import STORE_SCHEMA
from delaystats.streaming import ingest as streaming
from test_ingest import line, write


def run(spark, src, base, ckpt):
    q = streaming.start_stream_load(spark, src, f"{base}/table", f"{base}/rejects", ckpt,
                                    cluster_by=("uniquecarrier", "flightnum", "day"))
    q.awaitTermination()
    assert q.exception() is None
    return streaming.read_loaded(spark, f"{base}/table", STORE_SCHEMA.__class__(
        [f for f in STORE_SCHEMA.fields if not f.name.startswith("l_")]))


def test_files_load_once_in_batches(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    write(src, "a.csv", [line(flightnum="1", arrdelay="5"), line(flightnum="2", arrdelay="NA")])
    write(src, "b.csv", [line(flightnum="1", arrdelay="7")])
    ckpt = os.path.join(tmpdir_path, "ckpt")
    df = run(spark, src, tmpdir_path, ckpt)
    rows = df.collect()
    assert len(rows) == 2 and {r["batch_id"] for r in rows} == {0, 1}
    assert spark.read.parquet(f"{tmpdir_path}/rejects").count() == 1

    # a second run with the same checkpoint picks up only the new file
    write(src, "c.csv", [line(flightnum="1", arrdelay="9")])
    df = run(spark, src, tmpdir_path, ckpt)
    assert df.count() == 3

    latest = streaming.read_upserted(spark, f"{tmpdir_path}/table", STORE_SCHEMA.__class__(
        [f for f in STORE_SCHEMA.fields if not f.name.startswith("l_")]), KEY_BY_DAY, [])
    got = latest.collect()
    assert len(got) == 1 and got[0]["arrdelay"] == 9
