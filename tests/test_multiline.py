"""CSV records over several lines, cut by split borders at every place."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from delaystats.schema import COLUMNS
from delaystats.sources import multiline
from test_ingest import GOOD, HEADER


@pytest.fixture
def tiny_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def write(path, rows, end="\n", header=True):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    if header:
        w.writerow(COLUMNS)
    w.writerows(rows)
    path.write_bytes(out.getvalue().encode())
    return str(path)


def rows_of(n, seed):
    r = random.Random(seed)
    parts = ["a", "é", " ", ",", '"', "\n", "\n\n", '""', '",', "\r\n", "long " * 20, "\n" * 40]
    out = []
    for i in range(n):
        row = [GOOD[c] for c in COLUMNS]
        row[COLUMNS.index("flightnum")] = str(i)
        row[COLUMNS.index("tailnum")] = "".join(r.choice(parts) for _ in range(r.choice([0, 1, 2, 6, 30])))
        row[-1] = r.choice(["", "0", "end\nof row"])
        out.append(row)
    return out


def read(spark, paths, **kw):
    df = multiline.read_multiline_csv(spark, paths, **kw)
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_csv_module_at_every_border(spark, tmp_path, tiny_splits, end):
    rows = rows_of(120, 4)
    path = write(tmp_path / "a.csv", rows, end)
    lines = multiline._lines(spark, path)
    assert lines.select("file", "at").distinct().count() > 15                      # the file is split
    assert multiline.chunk_ends(lines).where("after = 1").count() > 3              # and records are cut
    assert read(spark, path) == sorted(map(tuple, rows))


def test_several_files_headers_and_shapes(spark, tmp_path, tiny_splits):
    a, b = rows_of(40, 1), rows_of(30, 2)
    pa, pb = write(tmp_path / "a.csv", a), write(tmp_path / "b.csv", b)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text(HEADER + "\n\n\n")
    assert read(spark, [pa, pb, str(tmp_path / "empty.csv"), str(tmp_path / "head.csv")]) == sorted(map(tuple, a + b))
    assert len(read(spark, pa, header=False)) == 41
    bad = tmp_path / "bad.csv"
    good = ",".join(GOOD[c] for c in COLUMNS)
    bad.write_text(HEADER + f'\n{good}\nshort,"two\nlines"\n{good},"x\ny"\n5" pipe,{good}\n{good}\n')
    df = multiline.read_multiline_csv(spark, str(bad))
    assert df.count() == 5 and df.where("_corrupt_record is null").count() == 2
    assert sorted(r[0] for r in df.where("_corrupt_record is not null").select("year").collect()) == ["2007", "5\" pipe", "short"]


def test_a_quote_that_never_closes_takes_the_rest(spark, tmp_path, tiny_splits):
    good = ",".join(GOOD[c] for c in COLUMNS)
    path = tmp_path / "open.csv"
    path.write_text(HEADER + f"\n{good}\n" + '"open,' + f"{good}\n" * 30)
    df = multiline.read_records(spark, str(path))
    texts = sorted((r["record"] for r in df.collect()), key=len)
    assert len(texts) == 3 and texts[-1].count("\n") == 29


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='a,"\n', max_size=8), min_size=1, max_size=6))
def test_line_states_match_the_csv_module(fields):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow(fields)
    inside, lines = False, out.getvalue()[:-1].split("\n")
    for i, line in enumerate(lines):
        inside = multiline.ends_inside(line, inside)
        assert inside == (i < len(lines) - 1)
