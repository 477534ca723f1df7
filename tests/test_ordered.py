"""Run grouping and ordinals against a brute-force pandas answer.

Small hand-made frames with one hot scope (more than a third of the rows),
runs crossing many range-partition boundaries, NULL keys and NULL values.
"""

import numpy as np
import pandas as pd
import pytest

from delaystats.operators import ordered


def make_frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    scope = np.where(rng.random(n) < 0.5, 1, rng.integers(2, 6, n))   # scope 1 is hot
    key = rng.choice(["A", "B", "C"], n, p=[0.6, 0.3, 0.1]).astype(object)
    key[rng.random(n) < 0.02] = None
    val = rng.integers(-20, 100, n).astype(float)
    val[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"s": scope.astype(np.int32), "o1": rng.integers(0, 50, n).astype(np.int64),
                        "o2": np.arange(n, dtype=np.int64), "k": key, "v": val})
    pdf["v"] = pdf["v"].astype("Int64")
    df = spark.createDataFrame(pdf, "s int, o1 bigint, o2 bigint, k string, v bigint")
    return df, pdf


def brute_runs(pdf):
    p = pdf.sort_values(["s", "o1", "o2"]).reset_index(drop=True)
    prev_k = p.groupby("s")["k"].shift()
    first = p["s"] != p["s"].shift()
    brk = first | p["k"].isna() | prev_k.isna() | (p["k"] != prev_k)
    p["run"] = brk.astype(int).groupby(p["s"]).cumsum()
    out = (p.groupby(["s", "run"], dropna=False)
           .agg(k=("k", "first"), total=("v", lambda x: x.sum() if x.notna().any() else None)))
    return sorted((int(s), int(r), k, None if pd.isna(t) else int(t))
                  for (s, r), k, t in zip(out.index, out["k"], out["total"]))


@pytest.mark.parametrize("parts", [1, 3, 17, 64])
def test_span_by_matches_brute_force(spark, parts):
    df, pdf = make_frame(spark)
    spans = ordered.span_by(df, key="k", order=["o1", "o2"], within=["s"], value="v",
                            num_partitions=parts)
    got = sorted((r["s"], r["run"], r["k"], r["total"]) for r in spans.runs().collect())
    want = brute_runs(pdf)
    assert got == want
    assert spans.count().first()["n"] == len(want)


def test_one_long_run_across_all_partitions(spark):
    n = 2000
    pdf = pd.DataFrame({"s": np.ones(n, dtype=np.int32), "o1": np.zeros(n, dtype=np.int64),
                        "o2": np.arange(n, dtype=np.int64), "k": ["A"] * n,
                        "v": np.ones(n, dtype=np.int64)})
    df = spark.createDataFrame(pdf, "s int, o1 bigint, o2 bigint, k string, v bigint")
    runs = ordered.span_by(df, "k", ["o1", "o2"], ["s"], "v", num_partitions=16).runs().collect()
    assert [(r["s"], r["run"], r["k"], r["total"]) for r in runs] == [(1, 1, "A", n)]


@pytest.mark.parametrize("parts", [1, 5, 23])
def test_ordinal_within_matches_row_number(spark, parts):
    df, pdf = make_frame(spark, n=1500, seed=3)
    got = ordered.ordinal_within(df, ["s"], ["o1", "o2"], num_partitions=parts)
    got = sorted((r["o2"], r["pos"]) for r in got.collect())
    p = pdf.sort_values(["s", "o1", "o2"])
    p["pos"] = p.groupby("s").cumcount() + 1
    want = sorted(zip(p["o2"].astype(int), p["pos"].astype(int)))
    assert got == want


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ROWS = st.lists(st.tuples(st.integers(1, 3),                       # scope
                          st.sampled_from(["A", "B", None]),        # key
                          st.one_of(st.none(), st.integers(-5, 5))),  # value
                min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.integers(1, 9))
def test_span_by_property(spark, rows, parts):
    pdf = pd.DataFrame({"s": [r[0] for r in rows], "o1": np.zeros(len(rows), dtype=np.int64),
                        "o2": np.arange(len(rows), dtype=np.int64), "k": [r[1] for r in rows],
                        "v": pd.array([r[2] for r in rows], dtype="Int64")})
    pdf["s"] = pdf["s"].astype(np.int32)
    df = spark.createDataFrame(pdf, "s int, o1 bigint, o2 bigint, k string, v bigint")
    spans = ordered.span_by(df, "k", ["o1", "o2"], ["s"], "v", num_partitions=parts)
    got = sorted((r["s"], r["run"], r["k"], r["total"]) for r in spans.runs().collect())
    assert got == brute_runs(pdf)


def test_span_by_fractional_values(spark):
    df, pdf = make_frame(spark, n=800, seed=11)
    df = df.withColumn("v", (df["v"] / 4).cast("double"))
    pdf["v"] = pdf["v"].astype("Float64") / 4
    spans = ordered.span_by(df, "k", ["o1", "o2"], ["s"], "v", num_partitions=7)
    got = sorted((r["s"], r["run"], r["k"], r["total"]) for r in spans.runs().collect())
    p = pdf.sort_values(["s", "o1", "o2"]).reset_index(drop=True)
    prev_k = p.groupby("s")["k"].shift()
    brk = (p["s"] != p["s"].shift()) | p["k"].isna() | prev_k.isna() | (p["k"] != prev_k)
    p["run"] = brk.astype(int).groupby(p["s"]).cumsum()
    want = sorted((int(s), int(r), g["k"].iloc[0],
                   None if g["v"].notna().sum() == 0 else float(g["v"].sum()))
                  for (s, r), g in p.groupby(["s", "run"]))
    assert [w[:3] for w in want] == [x[:3] for x in got]
    for (_, _, _, a), (_, _, _, b) in zip(got, want):
        assert (a is None and b is None) or abs(a - b) < 1e-9


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(scopes=st.lists(st.integers(1, 3), min_size=1, max_size=50), parts=st.integers(1, 9))
def test_ordinal_within_property(spark, scopes, parts):
    pdf = pd.DataFrame({"s": np.array(scopes, dtype=np.int32),
                        "o1": np.zeros(len(scopes), dtype=np.int64),
                        "o2": np.arange(len(scopes), dtype=np.int64)})
    df = spark.createDataFrame(pdf, "s int, o1 bigint, o2 bigint")
    got = sorted((r["o2"], r["pos"]) for r in
                 ordered.ordinal_within(df, ["s"], ["o1", "o2"], num_partitions=parts).collect())
    pdf["pos"] = pdf.groupby("s").cumcount() + 1
    assert got == sorted(zip(pdf["o2"].astype(int), pdf["pos"].astype(int)))


@pytest.mark.parametrize("parts", [None, 5])
def test_values_of_any_type_are_unchanged(spark, parts):
    import datetime as dt
    from decimal import Decimal
    big = 2**53 + 1
    rows = [(1, i, None if i % 3 == 0 else big + 2 * (i % 2), big + 2 * i if i % 4 else None,
             Decimal(f"12345678901234567890.{i:02d}"), [big, None], dt.datetime(2020, 1, 1, 0, 0, 0, i))
            for i in range(40)]
    df = spark.createDataFrame(rows, "s int, o bigint, k bigint, v bigint, d decimal(24,2), a array<bigint>, t timestamp")
    got = ordered.ordinal_within(df, ["s"], ["o"], num_partitions=parts).orderBy("o").collect()
    assert [tuple(r) for r in got] == [(*r, i + 1) for i, r in enumerate(rows)]
    runs = ordered.span_by(df, "k", ["o"], ["s"], "v", num_partitions=parts).runs().orderBy("run").collect()
    want = []
    for _, _, k, v, *_ in rows:
        if want and k is not None and want[-1][0] == k:
            want[-1][1].append(v)
        else:
            want.append((k, [v]))
    sums = [(k, sum(x for x in vs if x is not None) if any(x is not None for x in vs) else None) for k, vs in want]
    assert [(r["k"], r["total"]) for r in runs] == sums
    total = ordered.span_by(df, "k", ["o"], ["s"], "d", num_partitions=parts).runs().agg({"total": "sum"}).first()[0]
    assert total == sum(r[4] for r in rows)


def test_a_hot_scope_is_cut_and_small_scopes_are_not(spark, monkeypatch):
    from delaystats.plans.explain import plan_text
    df = spark.range(20_000).selectExpr("cast(if(id % 3 = 0, id, 0) as int) s", "id o", "id % 7 k", "id v")
    plain = ordered.ordinal_within(df, ["s"], ["o"])
    want = sorted(map(tuple, plain.select("o", "pos").collect()))
    assert "Python" not in plan_text(plain)
    monkeypatch.setattr(ordered, "LEAST_ROWS", 500)
    cut = ordered.in_chunks(df, ["s"], ["o"])
    sizes = cut.where("s = 0").groupBy("_chunk").count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < 3000
    got = ordered.ordinal_within(df, ["s"], ["o"])
    assert "InArrow" not in plan_text(got) and "InPandas" not in plan_text(got)
    assert sorted(map(tuple, got.select("o", "pos").collect())) == want
    assert ordered.ordinal_within(df.where("o < 0"), ["s"], ["o"]).collect() == []
    assert ordered.span_by(df.where("o < 0"), "k", ["o"], ["s"], "v").runs().collect() == []


def test_cached_pieces_of_cut_scopes_are_not_stored_twice(spark):
    from delaystats.plans import catalog
    df = spark.range(3000).selectExpr("cast(id % 2 as int) s", "id o", "cast(id / 5 as int) k", "id v")
    got = []
    for parts, on_disk in ((1, True), (6, False)):
        spans = catalog.kept_spans(ordered.span_by(df, "k", ["o"], ["s"], "v", num_partitions=parts))
        assert spans.pieces.storageLevel.useMemory and spans.pieces.storageLevel.useDisk == on_disk
        got.append(sorted(map(tuple, spans.runs().collect())))
        spans.pieces.unpersist()
    assert got[0] == got[1]
