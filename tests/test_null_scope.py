"""A null scope is a scope of its own: no row is lost."""

from delaystats.operators import ordered


def test_null_scope_rows_kept(spark):
    rows = [(None, 1, "a", 5), (None, 2, "a", 7), (1, 1, "a", 3), (1, 2, "b", 4), (2, 1, "a", 12)]
    df = spark.createDataFrame(rows, "s int, o int, k string, v long")
    for parts in (1, 3):
        got = ordered.ordinal_within(df, ["s"], ["o"], num_partitions=parts).collect()
        assert sorted((r.s is None, r.s or 0, r.o, r.pos) for r in got) == [
            (False, 1, 1, 1), (False, 1, 2, 2), (False, 2, 1, 1), (True, 0, 1, 1), (True, 0, 2, 2)]
        spans = ordered.span_by(df, "k", ["o"], ["s"], "v", num_partitions=parts)
        runs = spans.runs().collect()
        assert sum(r.total for r in runs) == 31 and len(runs) == 4
        assert spans.count().first().n == 4
