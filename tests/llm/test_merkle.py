"""Merkle manifest against a brute-force tree, its SQL, and edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from delaystats.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, scope int, pos string, items int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, at, new):
    """(root, root with node ``at`` replaced by ``new``, its siblings in order)."""
    fan, seen = merkle.FANOUT, []
    while len(nodes) > 1:
        start = at // fan * fan
        run = nodes[start:start + fan]
        i = at - start
        seen += run[:i] + run[i + 1:]
        new = sha("".join(run[:i] + [new] + run[i + 1:]))
        nodes = [sha("".join(nodes[k:k + fan])) for k in range(0, len(nodes), fan)]
        at //= fan
    return nodes[0], new, seen


def brute(rows):
    scopes = {}
    for r in rows:
        low = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        scopes.setdefault(b"" if r[1] is None else b":" + r[1].encode(), []).append(
            (r[0] is not None, r[0] or 0, leaf(r), leaf((*r[:4], low)) if hit else leaf(r)))
    order = sorted(scopes)
    trees = {s: sorted(scopes[s]) for s in order}
    tops = [climb([x[2] for x in trees[s]], 0, "")[0] for s in order]
    out = []
    for k, s in enumerate(order):
        nodes = [x[2] for x in trees[s]]
        for i, (known, doc_id, own, new) in enumerate(trees[s]):
            _, folded, low = climb(nodes, i, new)
            root, folded, high = climb(tops, k, folded)
            out.append((doc_id if known else None, own, tops[k], root, sha("".join(low + high)), folded, folded == root))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def proofs(spark, rows):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    m = merkle.build(table(spark, rows), changed, merkle.lower_ascii(F.col("text")))
    return m, sorted((tuple(r) for r in m.proofs().select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def make(sizes):
    rows, n = [], 0
    for s, size in sizes:
        for _ in range(size):
            rows.append((n, s, None if n % 7 == 0 else "en", n if n % 5 else None,
                         None if n % 11 == 0 else f"Text É {n} {'AB' * (n % 3)}"))
            n += 1
    return rows


@pytest.mark.parametrize("fanout, sizes", [
    (2, [(None, 1), ("a", 70), ("A", 8), ("é", 9), ("", 64), ("b", 3)]),       # several tiers of blocks
    (2, [(f"s{i}", 1) for i in range(19)]),                                        # several tiers of scopes
    (16, [("a", 17), ("b", 16), ("c", 1)]),
    (3, [("only", 28)]),
    (2, [("one", 1)]),
])
def test_proofs_match_brute_force(spark, monkeypatch, fanout, sizes):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "BLOCK", fanout ** 3)
    rows = make(sizes)
    assert proofs(spark, rows)[1] == brute(rows)


def test_null_ids_repeats_empty_and_long_texts(spark):
    rows = [(None, "s", None, None, None), (5, "s", "en", 0, ""), (5, "s", "en", 0, ""), (5, "s", "en", 1, "B"),
            (5, None, "en", 0, "Aa" * 300_000), (-3, "s", "en", 2**62, "x")]
    assert proofs(spark, rows)[1] == brute(rows)
    m, none = proofs(spark, [])
    assert m.root is None and none == [] and m.versions().collect() == []


def test_versions_copy_the_path_and_share_the_rest(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FANOUT", 2)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = make([("a", 20), ("b", 3)])
    m, got = proofs(spark, rows)
    folded = {r[0]: r[5] for r in got}
    versions = {}
    for r in m.versions().orderBy("doc_id", "level").collect():
        versions.setdefault(r["doc_id"], []).append(r["digest"])
    assert sorted(versions) == [r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    for doc_id, nodes in versions.items():
        height = 5 if doc_id < 20 else 2            # levels of the source's tree
        assert len(nodes) == 1 + height + 1 and nodes[-1] == folded[doc_id]


def test_sql_agrees(spark, tmp_path):
    import duckdb
    rows = make([(None, 2), ("a", 40), ("B", 17)]) + [(None, "a", None, None, None)]
    table(spark, rows).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    got = con.execute(merkle.manifest_sql(4, 2)).fetchall()
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
