"""Merkle manifest of a dataset as a persistent, path-copying tree.

Each row is a leaf; a scope (source) has a tree of its leaves in id order with
FANOUT children a node, and the scopes' roots, in order, have one more.  The
trees are kept as *aligned blocks*: BLOCK = FANOUT ** 3 consecutive nodes and
the three levels above them, so that a block is a row of bounded size whatever
the size of its scope, and its height follows from the block alone: a block of
fewer than BLOCK nodes that is the first of its scope ends in the scope's root,
every other one reaches exactly three levels up.

* Bottom up, a tier of blocks gives the nodes of the next tier, until every
  scope has one block (one tier more per factor BLOCK), then the same over the
  scopes' roots.
* Top down, every block learns its *trunk*: for each level above it the
  siblings of its root, ordered, up to the dataset's root.
* A changed leaf makes a new version of the tree.  Nothing is rewritten: the
  version shares all untouched nodes and copies only the leaf's ancestors,
  first inside its block, then along the trunk, which is shared by the block's
  versions and joined by block, so that a scope's versions are spread over
  tasks like its leaves.  The last copy is the version's root.

Positions come from a distributed prefix sum; no scope, however large, and no
set of versions meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import written
from delaystats.operators.ordered import ordinal_within

FANOUT = 16
BLOCK = FANOUT ** 3

#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: list[Column]) -> Column:
    """Binary SHA-256 of the fields: ``-`` for a null, else length in UTF-8
    bytes, colon, value."""
    text = [c.cast("string") for c in fields]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), 256))


def join_digests(digests: list[bytes]) -> bytes:
    """Node of its children's digests, as hex text."""
    return sha256(b"".join(d.hex().encode() for d in digests)).digest()


def levels_of(digests: list[bytes], whole: bool) -> list[list[bytes]]:
    """The nodes of a block, level by level: up to one node, and in a block of
    a larger tree (not ``whole``) exactly three levels up."""
    levels = [digests]
    while len(levels[-1]) > 1 if whole else len(levels) < 4:
        last = levels[-1]
        levels.append([join_digests(last[i:i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return levels


def is_whole(block: int, n: int) -> bool:
    return block == 0 and n < BLOCK


@dataclass
class Level:
    """Siblings of one node: how many stand before it, and their hex texts."""

    left: int
    siblings: bytes

    def parent(self, digest: bytes) -> bytes:
        """The copied parent of a new version of the node."""
        cut = 64 * self.left
        return sha256(self.siblings[:cut] + digest.hex().encode() + self.siblings[cut:]).digest()


def paths_of(levels: list[list[bytes]], trunk: list[Level]) -> Iterator[list[Level]]:
    """For each node of the lowest level its siblings up to the tree's root.
    Levels that nodes share are made once."""
    def siblings(level: list[bytes]) -> list[Level]:
        text = [d.hex().encode() for d in level]
        out = []
        for start in range(0, len(text), FANOUT):
            run = text[start:start + FANOUT]
            out += [Level(i, b"".join(run[:i] + run[i + 1:])) for i in range(len(run))]
        return out

    above = [trunk]
    for level in reversed(levels[:-1]):
        above = [[own, *above[i // FANOUT]] for i, own in enumerate(siblings(level))]
    return iter(above)


def _blocks(nodes: DataFrame, what: str) -> DataFrame:
    """(scope, block, items, root) of (scope, pos, item struct with digest);
    at most BLOCK nodes come together in a row."""
    rows = nodes.groupBy("scope", F.floor(F.col("pos") / BLOCK).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("items"))
    rows = rows.select("scope", "block", F.col("items.item").alias("items"))
    schema = rows.withColumn("root", F.lit(b"")).schema
    return written(rows.mapInArrow(_roots, schema), what)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            digests = row.column(2).flatten().field("digest").to_pylist()
            root = levels_of(digests, is_whole(row.column(1)[0].as_py(), len(digests)))[-1][0]
            yield pa.record_batch([*row.columns, pa.array([root], pa.binary())], [*row.schema.names, "root"])


def _tiers(nodes: DataFrame, what: str) -> list[DataFrame]:
    """Tiers of blocks, the nodes' own first, the last with one block a scope."""
    tiers = [_blocks(nodes, what)]
    while not tiers[-1].where("block > 0").isEmpty():
        up = tiers[-1].select("scope", F.col("block").alias("pos"), F.struct(F.col("root").alias("digest")).alias("item"))
        tiers.append(_blocks(up, what))
    return tiers


_TRUNK = "scope string, pos long, subroot binary, lefts array<int>, siblings array<binary>"


def _child_trunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = batch.column("items")
        for i, row in enumerate(batch.select(["scope", "block", "subroot", "lefts", "siblings"]).to_pylist()):
            digests = items[i].values.field("digest").to_pylist()
            trunk = [Level(a, b) for a, b in zip(row["lefts"], row["siblings"])]
            paths = list(paths_of(levels_of(digests, is_whole(row["block"], len(digests))), trunk))
            n = len(paths)
            yield pa.record_batch({
                "scope": pa.array([row["scope"]] * n, pa.string()), "pos": pa.array(
                    range(BLOCK * row["block"], BLOCK * row["block"] + n), pa.int64()),
                "subroot": pa.array([row["subroot"]] * n, pa.binary()),
                "lefts": pa.array([[x.left for x in p] for p in paths], pa.list_(pa.int32())),
                "siblings": pa.array([[x.siblings for x in p] for p in paths], pa.list_(pa.binary()))})


def _with_trunks(blocks: DataFrame, trunks: DataFrame) -> DataFrame:
    return blocks.drop("root").join(trunks.withColumnRenamed("pos", "block"), ["scope", "block"])


def _descend(tiers: list[DataFrame], trunks: DataFrame) -> DataFrame:
    """Trunks of the lowest tier's blocks, from those of the highest one's."""
    for blocks in reversed(tiers[1:]):
        trunks = written(_with_trunks(blocks, trunks).mapInArrow(_child_trunks, _TRUNK), "merkle-trunks")
    return trunks


@dataclass
class Manifest:
    """The tree of a table: its root, and its leaf blocks with their trunks."""

    root: str | None            # hex; None for an empty table
    leaves: DataFrame           # scope, block, items (doc_id, digest, changed), subroot, lefts, siblings

    def proofs(self) -> DataFrame:
        """Per row: doc_id, leaf, subroot, root, proof_sha256 (of its siblings,
        from its run up to the root), folded_root (its path folded from the
        changed leaf where there is one) and verified."""
        return self.leaves.mapInArrow(
            _proofs(self.root), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean")

    def versions(self) -> DataFrame:
        """The nodes that the versions of changed leaves do not share with the
        tree: (doc_id, level, digest), the leaf itself as level 0, the root of
        the version last.  All others are the tree's own."""
        return self.leaves.mapInArrow(_versions, "doc_id long, level int, digest string")


def _leaf_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict], list[list[Level]]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            digests = [x["digest"] for x in row["items"]]
            trunk = [Level(a, b) for a, b in zip(row["lefts"], row["siblings"])]
            yield row, row["items"], list(paths_of(levels_of(digests, is_whole(row["block"], len(digests))), trunk))


def _copies(digest: bytes, path: list[Level]) -> Iterator[bytes]:
    yield digest
    for level in path:
        digest = level.parent(digest)
        yield digest


def _proofs(root: str | None):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, items, paths in _leaf_paths(batches):
            out: dict[str, list] = {"doc_id": [], "leaf": [], "proof_sha256": [], "folded_root": []}
            for item, path in zip(items, paths):
                *_, folded = _copies(item["changed"] or item["digest"], path)
                out["doc_id"].append(item["doc_id"])
                out["leaf"].append(item["digest"].hex())
                out["proof_sha256"].append(sha256(b"".join(x.siblings for x in path)).hexdigest())
                out["folded_root"].append(folded.hex())
            n = len(items)
            yield pa.record_batch({
                "doc_id": pa.array(out["doc_id"], pa.int64()), "leaf": pa.array(out["leaf"], pa.string()),
                "subroot": pa.array([row["subroot"].hex()] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                "proof_sha256": pa.array(out["proof_sha256"], pa.string()),
                "folded_root": pa.array(out["folded_root"], pa.string()),
                "verified": pa.array([x == root for x in out["folded_root"]], pa.bool_())})
    return fn


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, items, paths in _leaf_paths(batches):
        rows = [(item["doc_id"], level, node.hex()) for item, path in zip(items, paths) if item["changed"]
                for level, node in enumerate(_copies(item["changed"], path))]
        ids, levels, nodes = zip(*rows) if rows else ([], [], [])
        yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "level": pa.array(levels, pa.int32()),
                               "digest": pa.array(nodes, pa.string())})


def build(docs: DataFrame, changed: Column | None = None, new_text: Column | None = None) -> Manifest:
    """The manifest of a table with the columns FIELDS, others left out.

    Where ``changed`` is true, a version of the tree is made in which the row's
    text is ``new_text``.  A null field counts as ``-`` in its leaf; rows
    without a source are a scope of their own, the first one; null ids come
    first in their scope, and rows of equal id are ordered by their leaf, so
    equal rows are equal leaves side by side.  An empty table has no root and
    no rows.
    """
    fields = [F.col(c) for c in FIELDS]
    other = leaf_digest([*fields[:-1], new_text]) if new_text is not None else F.lit(None).cast("binary")
    leaves = written(docs.select(
        F.coalesce(F.concat(F.lit(":"), F.col("source").cast("string")), F.lit("")).alias("scope"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(fields).alias("digest"),
        F.when(changed if changed is not None else F.lit(False), other).alias("changed")), "merkle-leaves")
    placed = ordinal_within(leaves, ["scope"], ["doc_id", "digest"])
    tiers = _tiers(placed.select("scope", (F.col("pos") - 1).alias("pos"),
                                 F.struct("doc_id", "digest", "changed").alias("item")), "merkle-blocks")
    scopes = tiers[-1].select(F.lit("").alias("all"), "scope", "root")
    scopes = written(ordinal_within(scopes, ["all"], ["scope"]).select(
        "scope", (F.col("pos") - 1).alias("pos"), "root"), "merkle-scopes")
    upper = _tiers(scopes.select(F.lit("").alias("scope"), "pos", F.struct(F.col("root").alias("digest")).alias("item")),
                   "merkle-upper")
    top = upper[-1].select("root").first()
    none = F.array()
    start = upper[-1].select("scope", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("subroot"),
                             none.cast("array<int>").alias("lefts"), none.cast("array<binary>").alias("siblings"))
    trunks = _with_trunks(upper[0], _descend(upper, start)).mapInArrow(_child_trunks, _TRUNK)
    trunks = trunks.drop("scope", "subroot").join(scopes, "pos").select(
        "scope", F.lit(0).cast("long").alias("pos"), F.col("root").alias("subroot"), "lefts", "siblings")
    leaves = _with_trunks(tiers[0], _descend(tiers, written(trunks, "merkle-trunks")))
    return Manifest(top["root"].hex() if top else None, leaves)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest_sql(depth: int = 8, upper: int = 5) -> str:
    """DuckDB SQL of ``op11``: trees of at most FANOUT ** depth leaves a scope
    and FANOUT ** upper scopes, one level of nodes and of paths after the other."""
    def field(c: str, value: str | None = None) -> str:
        v = f"CAST({value or c} AS STRING)"
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({v}), ':', {v}) END"

    def leaf(text: str) -> str:
        return f"sha256(concat({', '.join(field(c) for c in FIELDS[:-1])}, {field('text', text)}))"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = ("list_concat([4294967295], flatten(list_transform(range(1, length(s) + 1), "
             "lambda i: [ascii(s[i]), -1, -1, -1, -1, -1, -1, -1, -1])))")
    crc = (f"xor(list_reduce({steps}, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
           "WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)")
    ctes = [
        "d AS (SELECT *, CAST(doc_id AS STRING) AS s FROM documents)",
        f"x AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE ':' || source END AS scope, {leaf('text')} AS leaf, "
        f"CASE WHEN {crc} % 5 = 0 THEN {leaf(low)} END AS changed FROM d)",
        "p0 AS (SELECT *, row_number() OVER (ORDER BY scope, doc_id NULLS FIRST, leaf) AS id, "
        "row_number() OVER (PARTITION BY scope ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, "
        "coalesce(changed, leaf) AS folded, '' AS proof FROM x)",
        "t0 AS (SELECT scope, pos, leaf AS d FROM p0)",
    ]

    def level(t: str, p: str, to_t: str, to_p: str) -> None:
        run = f"r{to_t}"
        ctes.append(f"{run} AS (SELECT scope, pos // {FANOUT} AS pos, list(d ORDER BY pos) AS ds, any_value(many) AS many "
                    f"FROM (SELECT *, count(*) OVER (PARTITION BY scope) > 1 AS many FROM {t}) a GROUP BY scope, pos // {FANOUT})")
        ctes.append(f"{to_t} AS (SELECT scope, pos, CASE WHEN many THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d "
                    f"FROM {run})")
        i = f"CAST(p.pos % {FANOUT} AS INT)"
        ctes.append(
            f"{to_p} AS (SELECT p.* REPLACE (p.pos // {FANOUT} AS pos, CASE WHEN many THEN sha256(array_to_string("
            f"list_concat(ds[1:{i}], [folded], ds[{i} + 2:]), '')) ELSE folded END AS folded, CASE WHEN many THEN concat("
            f"proof, array_to_string(list_concat(ds[1:{i}], ds[{i} + 2:]), '')) ELSE proof END AS proof) "
            f"FROM {p} p JOIN {run} r ON r.scope = p.scope AND r.pos = p.pos // {FANOUT})")

    for k in range(depth):
        level(f"t{k}", f"p{k}", f"t{k + 1}", f"p{k + 1}")
    ctes.append(f"s AS (SELECT scope AS own, d AS subroot, row_number() OVER (ORDER BY scope) - 1 AS place FROM t{depth})")
    ctes.append("u0 AS (SELECT '' AS scope, place AS pos, subroot AS d FROM s)")
    ctes.append(f"q0 AS (SELECT p.* REPLACE (s.place AS pos, '' AS scope), s.subroot FROM p{depth} p JOIN s ON s.own = p.scope)")
    for k in range(upper):
        level(f"u{k}", f"q{k}", f"u{k + 1}", f"q{k + 1}")
    return (f"WITH {', '.join(ctes)} SELECT q.doc_id, q.leaf, q.subroot, u.d AS root, sha256(q.proof) AS proof_sha256, "
            f"q.folded AS folded_root, q.folded = u.d AS verified FROM q{upper} q, u{upper} u")
