"""Phrases from the de Bruijn graph against plain counting, and its SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

from delaystats.llm import phrases

SCHEMA = "doc_id long, lang string, text string, n long, key string"


def grams(rows, sizes=(1, 2, 3)):
    f = Counter()
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            for k in sizes:
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang, tuple(w[i:i + k])] += 1
    return f


def brute(rows, least, top):
    f = grams(rows)
    cand = {x: n for x, n in f.items() if len(x[1]) > 1 and n >= least}
    out = {}
    for (lang, p), a in cand.items():
        if len(p) == 2 and any(100 * n >= 50 * a for (g, q), n in cand.items()
                               if g == lang and len(q) == 3 and p in (q[:2], q[1:])):
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    got = []
    for lang, rows_ in out.items():
        n = sum(c for (g, p), c in f.items() if g == lang and len(p) == 1)
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            got.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(got)


def corpus(seed, docs=150):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "é", "zz y", "<b>"]
    fixed = ["One two three four five six", "alpha beta gamma", "x x x x", "same pair w1 w2"]
    rows = []
    for _ in range(docs):
        words = []
        for _ in range(r.randint(0, 40)):
            words.append(r.choice(fixed) if r.random() < 0.2 else r.choice(vocabulary))
            if r.random() < 0.2:
                words.append(r.choice([".", ", ", "\n", " ! ", "\x0b", "\t"]))
        rows.append((r.choice(["en", "fr", None, "und", "a b"]), " ".join(words)))
    return rows + [("en", None), (None, ""), ("fr", " . , "), ("en", "lonely"), ("fr", "long " * 5000)]


def table(spark, rows):
    return spark.createDataFrame([(i, g, t, 1, "k") for i, (g, t) in enumerate(rows)], SCHEMA)


def test_graph_counts_equal_plain_counting(spark):
    rows = corpus(1)
    f = grams(rows)
    g = phrases.build(table(spark, rows), least=3)

    def of(df):
        return {(k.rpartition("\n")[0], tuple(k.rpartition("\n")[2].split(" "))): n for k, n in map(tuple, df.collect())}
    assert of(g.words) == {x: n for x, n in f.items() if len(x[1]) == 1}
    assert of(g.nodes) == {x: n for x, n in f.items() if len(x[1]) == 2 and n >= 3}
    assert of(g.edges) == {x: n for x, n in f.items() if len(x[1]) == 3 and n >= 3}


def test_hot_nodes_are_dealt_out_and_counted_right(spark, monkeypatch):
    rows = [("en", " ".join(f"hot pair n{i * 50 + j}" for j in range(50))) for i in range(40)]
    df = table(spark, rows).repartition(7)
    assert "en\nhot pair" in phrases._hot_nodes(df.select("lang", "text"))
    g = phrases.build(df, least=10)
    assert {r.key: r.n for r in g.nodes.collect()}["en\nhot pair"] == 2000
    assert {r.key: r.n for r in g.words.collect()}["en\nhot"] == 2000


def test_unary_chains_become_paths(spark):
    rows = [("en", "a b c d e f. q a b")] * 4 + [("en", "x d e y. c d")] * 3
    paths = {tuple(r["words"]): r["n"] for r in phrases.compact(phrases.build(table(spark, rows), least=2)).collect()}
    # (d e) has two ways on and (c d) ends three pieces, so the chain stops there
    assert paths == {("a", "b", "c", "d"): 4, ("c", "d", "e"): 4, ("d", "e", "f"): 4, ("x", "d", "e"): 3,
                     ("d", "e", "y"): 3, ("q", "a", "b"): 4}
    long = " ".join(f"w{i}" for i in range(70))
    (path,) = phrases.compact(phrases.build(table(spark, [("en", long)] * 3), least=3)).collect()
    assert (path["words"], path["n"]) == (long.split(), 3)


@pytest.mark.parametrize("seed, least, top", [(2, 3, 30), (3, 10, 2000)])
def test_collocations_match_brute_force_and_sql(spark, tmp_path, monkeypatch, seed, least, top):
    monkeypatch.setattr(phrases, "FLUSH_BYTES", 2000)
    rows = corpus(seed)
    df = table(spark, rows)
    want = brute(rows, least, top)
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, phrases.collocations(df, least, top).select(cols).collect())) == want
    df.select("doc_id", "lang", "text").write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert sorted(con.execute(phrases.collocations_sql(least, top)).fetchall()) == want


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 9 * 10**15 - 1, 10**16 - 3, 10**16 - 7
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = df.select(phrases._score("a", df.l, df.r).alias("s")).first().s
    assert got == 10**6 * a * a // (left * right)


def test_empty_tables(spark):
    assert phrases.collocations(table(spark, [])).collect() == []
    assert phrases.collocations(table(spark, [("en", None), (None, "")])).collect() == []
