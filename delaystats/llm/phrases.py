"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are pairs of neighbouring words, edges are triples: (w1 w2 w3) leads from
(w1 w2) to (w2 w3), its weight is how often it occurs.  Only edges are counted
in the texts, one per word: near the end of a piece the missing words are
empty, so an edge then leads to an end.  Everything shorter follows by flow:

* f(w1 w2) is what leaves the node, edges into ends included (the correction
  for pieces that end with it), and
* f(w1) is the sum over the nodes that begin with w1, the one of pieces that
  end in w1 included.

Arrow tasks aggregate the edges of some megabytes of text; these are shuffled by
node, sorted, and summed as a stream: edges, then nodes, then words, since a
sorted list of triples is sorted by its prefixes too.  Nodes that a sample
shows to be very frequent are dealt out by the whole edge instead, and their
partial flows are added afterwards, so that no node meets in one task.

What remains are the edges, nodes and words of at least ``least`` occurrences.
A node is *unary* if all its flow comes in by one edge and leaves by one: such
chains are compacted into paths by pointer doubling.  The paths of the graph
give the candidates: their triples, with the path's weight, and the nodes that
no path covers with half of their flow or more.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import written
from delaystats.operators.topk import limit_per_group

FLUSH_BYTES = 10 << 20      # text after which a task gives out its edges
HOT = 1000                  # a node with 1 / HOT of the sample is dealt out by edge
HOT_DOCS = 2000             # documents of that sample
#: What ends a piece, what separates words.
ENDS = b".,;:!?\n\x0b\x0c\r"
END, GAP = ord("."), ord(" ")
_TABLE = bytes(END if b in ENDS else GAP if b == 9 else b for b in range(256))


def _edges(hot: frozenset):
    """(lang, text) -> (deal, key, n): key is lang, newline, three words."""
    def flush(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        # a full stop is a word of its own now, and in no other word
        words = b".".join(texts).lower().translate(_TABLE).replace(b".", b" . ").split()
        ids: defaultdict = defaultdict(count(1).__next__)
        ids[b"."] = 0
        a = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        del words
        a = np.concatenate((a, [0, 0]))
        first, second = a[:-2], a[1:-1]
        third = np.where(second == 0, 0, a[2:])
        keys, n = np.unique((first << 42 | second << 21 | third)[first > 0], return_counts=True)
        w1, w2, w3 = keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF
        vocabulary = [b"", *list(ids)[1:]]
        text = pa.array(vocabulary, pa.binary())
        node = pc.binary_join_element_wise(pa.scalar(lang.encode() + b"\n"), text.take(w1), b"")
        node = pc.binary_join_element_wise(node, text.take(w2), b" ")
        key = pc.binary_join_element_wise(node, text.take(w3), b" ").cast(pa.string())
        digest = np.fromiter(map(crc32, vocabulary), np.int64, len(vocabulary))
        deal = (crc32(lang.encode()) + digest[w1] * 31 + digest[w2] * 1009) & 0x7FFFFFFF
        if hot:
            spread = pc.is_in(node.cast(pa.string()), pa.array(sorted(hot), pa.string())).to_numpy(zero_copy_only=False)
            deal = np.where(spread, (deal + digest[w3] * 65537) & 0x7FFFFFFF, deal)
        return pa.record_batch({"deal": pa.array(deal, pa.int64()).cast(pa.int32()), "key": key,
                                "n": pa.array(n, pa.int64())})

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: defaultdict = defaultdict(list)
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                texts[lang].append(raw)
                size += len(raw)
                if size >= FLUSH_BYTES:
                    for each in texts:
                        yield flush(each, texts[each])
                    texts.clear()
                    size = 0
        for each in texts:
            yield flush(each, texts[each])
    return fn


class _Runs:
    """Sums of equal neighbours in a stream of sorted keys."""

    def __init__(self) -> None:
        self.key: str | None = None
        self.sum = 0

    def feed(self, keys: pa.Array, n: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The runs that are complete; the last one stays open."""
        if not len(keys):
            return keys, n
        new = np.ones(len(keys), bool)
        new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(new)
        keys, n = keys.take(at), np.add.reduceat(n, at)
        if self.key is not None:
            if keys[0].as_py() == self.key:
                n[0] += self.sum
            else:
                keys = pa.concat_arrays([pa.array([self.key], pa.string()), keys])
                n = np.concatenate(([self.sum], n))
        self.key, self.sum = keys[-1].as_py(), int(n[-1])
        return keys[:-1], n[:-1]

    def close(self) -> tuple[pa.Array, np.ndarray]:
        done = [] if self.key is None else [self.key]
        return pa.array(done, pa.string()), np.array([self.sum] * len(done), np.int64)


def _prefix(keys: pa.Array) -> pa.Array:
    """Keys without their last word."""
    parts = pc.split_pattern(keys, " ", max_splits=1, reverse=True).flatten()
    return parts.take(np.arange(0, len(parts), 2))


def _flows(least: int, hot: frozenset):
    """Sorted (key, n) rows of a partition -> (kind, key, n): edges of ``least``
    and more (3), nodes of ``least`` and more or partial ones of hot nodes (2),
    partial words (1)."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, nodes, words = _Runs(), _Runs(), _Runs()

        def rows(kind: int, keys: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            keep = np.ones(len(keys), bool)
            if kind > 1:        # a key that ends in a space leads to an end
                keep = ~pc.ends_with(keys, " ").to_numpy(zero_copy_only=False)
                often = n >= least
                if kind == 2 and hot:
                    often |= pc.is_in(keys, pa.array(sorted(hot), pa.string())).to_numpy(zero_copy_only=False)
                keep &= often
            at = np.flatnonzero(keep)
            return pa.record_batch({"kind": pa.array(np.full(len(at), kind), pa.int32()), "key": keys.take(at),
                                    "n": pa.array(n[at], pa.int64())})

        def pass_on(done: tuple, last: int) -> Iterator[pa.RecordBatch]:
            """``done`` edges (last = 0), and what they complete further down."""
            yield rows(3, *done)
            done = nodes.feed(_prefix(done[0]), done[1])
            if last:
                tail = nodes.close()
                done = pa.concat_arrays([done[0], tail[0]]), np.concatenate((done[1], tail[1]))
            yield rows(2, *done)
            done = words.feed(_prefix(done[0]), done[1])
            if last:
                tail = words.close()
                done = pa.concat_arrays([done[0], tail[0]]), np.concatenate((done[1], tail[1]))
            yield rows(1, *done)

        for batch in batches:
            yield from pass_on(edges.feed(batch.column(0), batch.column(1).to_numpy().copy()), 0)
        yield from pass_on(edges.close(), 1)
    return fn


_EDGE = "deal int, key string, n long"


def _hot_nodes(rows: DataFrame) -> frozenset:
    """Nodes with a HOT-th of the words in a sample of some HOT_DOCS documents
    (at most HOT): they only change which task gets which edge."""
    total = rows.count()
    drawn = rows.sample(min(1.0, HOT_DOCS / max(total, 1)), seed=7)
    nodes = (drawn.mapInArrow(_edges(frozenset()), _EDGE)
             .groupBy(F.regexp_replace("key", " [^ ]*$", "").alias("node")).agg(F.sum("n").alias("n")))
    nodes = written(nodes, "phrases-sample")
    words = nodes.agg(F.sum("n")).first()[0] or 0
    return frozenset(r["node"] for r in nodes.where(F.col("n") * HOT >= max(words, 1)).select("node").collect())


@dataclass
class Graph:
    """Edges and nodes of ``least`` occurrences and more, and all words, as
    (key, n); a key is lang, newline, words."""

    edges: DataFrame
    nodes: DataFrame
    words: DataFrame


def build(docs: DataFrame, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> Graph:
    """The graph of a table's texts, a separate one for each language (null:
    ``und``).  Null and empty texts have no words; repeated rows count each;
    other columns are left out; an empty table gives an empty graph."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    hot = _hot_nodes(rows)
    dealt = rows.mapInArrow(_edges(hot), _EDGE).repartition("deal").sortWithinPartitions("key").select("key", "n")
    flows = written(dealt.mapInArrow(_flows(least, hot), "kind int, key string, n long"), "phrases", ["kind"])

    def summed(kind: int) -> DataFrame:
        return flows.where(F.col("kind") == kind).groupBy("key").agg(F.sum("n").alias("n"))

    return Graph(flows.where("kind = 3").select("key", "n"), summed(2).where(F.col("n") >= least), summed(1))


def _phrase(key: Column) -> Column:
    return F.substring_index(key, "\n", -1)


def _lang(key: Column) -> Column:
    return F.substring(key, F.lit(1), F.char_length(key) - F.char_length(_phrase(key)) - 1)


def _keys(lang: Column, words: Column, size: int) -> Column:
    """Keys of all windows of ``size`` words."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.concat(
        lang, F.lit("\n"), F.array_join(F.slice(words, i, F.lit(size)), " ")))


def compact(graph: Graph) -> DataFrame:
    """(lang, words, n): the edges joined into paths along unary nodes; an edge
    between two others stands for itself.  Every edge is in one path."""
    ends = graph.edges.select(
        F.col("key").alias("edge"), "n", F.regexp_replace("key", " [^ ]*$", "").alias("head"),
        F.concat(_lang(F.col("key")), F.lit("\n"), F.substring_index(_phrase(F.col("key")), " ", -2)).alias("tail"))
    ends = written(ends, "phrases-edges")
    full = graph.nodes.select(F.col("key").alias("node"), F.col("n").alias("flow"))
    into = ends.join(full, (F.col("tail") == F.col("node")) & (F.col("n") == F.col("flow"))).select(
        "node", F.col("edge").alias("before"))
    out = ends.join(full, (F.col("head") == F.col("node")) & (F.col("n") == F.col("flow"))).select("node", "edge")
    # (edge, the edge it goes back to, how far): doubled until all go back to a path's first edge.
    # No path is a ring: its pieces begin somewhere, and that node has more flow than its edges in.
    links = written(out.join(into, "node").select("edge", F.col("before").alias("back"), F.lit(1).alias("steps")),
                    "phrases-links")
    while True:
        further = links.select(F.col("edge").alias("back"), F.col("back").alias("first"), F.col("steps").alias("more"))
        joined = links.join(further, "back", "left")
        links = written(joined.select("edge", F.coalesce("first", "back").alias("back"),
                                      (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                                      F.col("first").isNotNull().alias("moved")), "phrases-links")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    placed = ends.join(links.drop("moved"), "edge", "left")
    members = F.sort_array(F.collect_list(F.struct(
        F.coalesce("steps", F.lit(0)).alias("steps"), _phrase(F.col("edge")).alias("phrase"))))
    paths = placed.groupBy(F.coalesce("back", "edge").alias("path")).agg(members.alias("edges"), F.first("n").alias("n"))
    words = F.concat(F.split(F.col("edges")[0]["phrase"], " "), F.transform(
        F.slice("edges", F.lit(2), F.size("edges")), lambda e: F.substring_index(e["phrase"], " ", -1)))
    return paths.select(_lang(F.col("path")).alias("lang"), words.alias("words"), "n")


def _score(a: str, left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (l r)), exact: whole decimals of up to 38 digits."""
    square = F.col(a).cast("decimal(16,0)") * F.col(a).cast("decimal(16,0)")
    scaled = (square * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    parts = left.cast("decimal(19,0)") * right.cast("decimal(19,0)")
    return F.call_function("div", scaled, parts.cast("decimal(38,0)"))


def candidates(graph: Graph, paths: DataFrame, least: int) -> DataFrame:
    """Phrases of two and three words: (lang, phrase, a, l, r, score) by their
    lowest-scoring cut, without the nodes that a longer candidate covers."""
    lang, phrase = _lang(F.col("key")), _phrase(F.col("key"))
    words = graph.words.where(F.col("n") >= least).select("key", F.col("n").alias("c"))
    nodes = graph.nodes.select("key", F.col("n").alias("a"), lang.alias("lang"), F.split(phrase, " ").alias("w"))
    for i, name in ((0, "l"), (1, "r")):        # a word of a node occurs as often as the node at least
        part = words.select(F.col("key").alias("part"), F.col("c").alias(name))
        nodes = nodes.withColumn("part", F.concat("lang", F.lit("\n"), F.col("w")[i])).join(part, "part").drop("part")
    nodes = written(nodes.drop("w"), "phrases-nodes")

    covered = paths.select(F.explode(_keys(F.col("lang"), F.col("words"), 2)).alias("key"), F.col("n").alias("c"))
    covered = covered.groupBy("key").agg(F.max("c").alias("c"))
    pairs = nodes.join(covered, "key", "left").where("c IS NULL OR 100 * c < 50 * a").select(
        "lang", phrase.alias("phrase"), "a", "l", "r", _score("a", F.col("l"), F.col("r")).alias("score"))

    triples = paths.select(F.explode(_keys(F.col("lang"), F.col("words"), 3)).alias("key"), F.col("n").alias("a"), "lang")
    heads = nodes.select(F.col("key").alias("head"), F.col("l").alias("l1"), F.col("a").alias("l2"))
    tails = nodes.select(F.col("key").alias("tail"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    triples = triples.withColumn("head", F.regexp_replace("key", " [^ ]*$", "")).withColumn(
        "tail", F.concat("lang", F.lit("\n"), F.substring_index(phrase, " ", -2)))
    triples = triples.join(heads, "head").join(tails, "tail").select(
        "lang", phrase.alias("phrase"), "a", "l1", "r1", "l2", "r2",
        _score("a", F.col("l1"), F.col("r1")).alias("s1"), _score("a", F.col("l2"), F.col("r2")).alias("s2"))
    early = F.col("s1") <= F.col("s2")
    triples = triples.select("lang", "phrase", "a", *[
        F.when(early, F.col(f"{x}1")).otherwise(F.col(f"{x}2")).alias(name)
        for x, name in (("l", "l"), ("r", "r"), ("s", "score"))])
    return pairs.unionByName(triples)


def collocations(docs: DataFrame, least: int = 10, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language by score, then count, then
    text: lang, rank, phrase, a, l, r, n (words of the language), score."""
    graph = build(docs, least)
    paths = written(compact(graph), "phrases-paths")
    total = graph.words.groupBy(_lang(F.col("key")).alias("lang")).agg(F.sum("n").alias("n"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    first = limit_per_group(candidates(graph, paths, least), ["lang"], order, top, rank_name="rank")
    return first.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            "n", "score")


def collocations_sql(least: int = 10, top: int = 2000) -> str:
    """DuckDB SQL of ``op13``: every phrase counted by itself."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array({low}, '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p
      FROM w, (VALUES (1), (2), (3)) s(k)),
f AS (SELECT lang, k, p, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, k, p),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= {least}),
cut AS (SELECT lang, p, f AS a, cut, p[1:cut] AS lp, p[cut + 1:] AS rp FROM c, (VALUES (1), (2)) s(cut) WHERE cut < k),
cuts AS (SELECT x.lang, x.p, a, cut, l.f AS l, r.f AS r, 1000000 * a * a // (l.f * r.f) AS score
         FROM cut x JOIN f l ON l.lang = x.lang AND l.p = x.lp JOIN f r ON r.lang = x.lang AND r.p = x.rp),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS o FROM cuts),
part AS (SELECT lang, p[1:2] AS p, f FROM c WHERE k = 3 UNION ALL SELECT lang, p[2:3], f FROM c WHERE k = 3),
inside AS (SELECT DISTINCT s.lang, s.p FROM c s JOIN part t ON t.lang = s.lang AND t.p = s.p WHERE 100 * t.f >= 50 * s.f),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (
             PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
           FROM best b WHERE o = 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.p = b.p))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""
