"""Benchmark decontamination by greedy string tiling.

Texts are the lower-cased letter-and-digit words.  A shared run of ``m`` words
between a document and a benchmark item is a seed; the join on seeds finds the
pairs worth tiling.  Running Karp-Rabin then looks for common runs of a search
length s (rolling hashes of all unmarked s-word windows), extends them as far
as words agree and are unmarked, marks the longest first, and goes on with
half of s down to m.  Tiles never overlap, in the item or in the document, but
their order is free, so a passage whose sentences were moved around is still
covered.  A document is contaminated by an item when the tiles cover at least
``threshold`` of the item's words.

Items shorter than m words must be found whole (m becomes their length).  The
benchmark is sent to the tasks in blocks of at most BLOCK_BYTES of text, each
gone over all documents, so what is broadcast has a fixed bound however large
the benchmark grows; the documents are never shuffled and never copied.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import lean

MIN_RUN = 5                 # words in a seed, and in the shortest tile
THRESHOLD = 0.5             # share of an item's words that tiles must cover
BLOCK_BYTES = 8 << 20       # benchmark text per pass over the documents

_WORD = re.compile(r"[^\W_]+")
_C = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """C^0 .. C^(n-1) modulo 2^64 and their inverses (kept in the task)."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(4096, 1 << n.bit_length())
        for name, base in (("up", int(_C)), ("down", pow(int(_C), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def windows(h: np.ndarray, s: int) -> np.ndarray:
    """Karp-Rabin hash of every s-word window, modulo 2^64: differences of the
    prefix sums of h[i] C^i, each divided by the power of its start."""
    if len(h) < s or not s:
        return h[:0]
    up, down = _powers(len(h))
    p = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)))
    x = (p[s:] - p[:-s]) * down[:len(h) - s + 1]
    return x ^ (x >> np.uint64(29))


def _free(marked: np.ndarray, s: int) -> np.ndarray:
    p = np.concatenate(([0], np.cumsum(marked)))
    return p[s:] == p[:-s]


def _matches(item, doc, marked_i, marked_d, s) -> list[tuple[int, int, int]]:
    """(-length, item start, doc start) of the maximal unmarked common runs of
    s words or more, found by their first s-word window."""
    if len(item) < s or len(doc) < s:
        return []
    at = defaultdict(list)
    for i, (x, free) in enumerate(zip(windows(item, s).tolist(), _free(marked_i, s))):
        if free:
            at[x].append(i)
    hashes = windows(doc, s)
    hit = np.isin(hashes, np.fromiter(at, np.uint64, len(at))) & _free(marked_d, s)
    out = []
    for j in np.flatnonzero(hit).tolist():
        for i in at[int(hashes[j])]:
            if i and j and not marked_i[i - 1] and not marked_d[j - 1] and item[i - 1] == doc[j - 1]:
                continue                    # not the start of its run
            top = min(len(item) - i, len(doc) - j)
            stop = (item[i:i + top] != doc[j:j + top]) | marked_i[i:i + top] | marked_d[j:j + top]
            n = int(stop.argmax()) if stop.any() else top
            if n >= s:
                out.append((-n, i, j))
    return sorted(out)


def tile(item: np.ndarray, doc: np.ndarray, m: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two hashed word sequences: (item start, doc
    start, length) of non-overlapping common runs of at least m words.  The
    longest run is always marked next; ties go to the first in the item, then
    in the document."""
    marked_i, marked_d = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []
    s = max(m, 20)
    while True:
        found = _matches(item, doc, marked_i, marked_d, s)
        for n, i, j in found:
            if marked_i[i:i - n].any() or marked_d[j:j - n].any():
                break                       # cut short by a longer one: scan again
            marked_i[i:i - n] = True
            marked_d[j:j - n] = True
            tiles.append((i, j, -n))
        if not found:
            if s == m:
                return sorted(tiles)
            s = max(m, s // 2)


class Index:
    """Seeds of one block of benchmark items: (item id, text) pairs."""

    def __init__(self, items: list[tuple[int, str | None]], m: int):
        self.items, self.seeds = {}, defaultdict(set)
        for number, (item_id, text) in enumerate(items):
            h = word_hashes(words_of(text))
            if not len(h):
                continue                    # an item without words contaminates nothing
            run = min(m, len(h))
            self.items[number] = (item_id, h, run)
            for x in windows(h, run).tolist():
                self.seeds[(run, x)].add(number)
        self.runs = sorted({run for run, _ in self.seeds})
        self.maps = {}
        for run in self.runs:
            bits = np.zeros(1 << 16, bool)
            bits[[x & 0xFFFF for r, x in self.seeds if r == run]] = True
            self.maps[run] = bits

    def coverage(self, text: str | None) -> list[tuple[int, int, int, list]]:
        """(item id, covered words, item words, tiles) of the items with seeds in the text."""
        h = word_hashes(words_of(text))
        found: dict[int, set[int]] = {}
        for run in self.runs:
            w = windows(h, run)
            for j in np.flatnonzero(self.maps[run][(w & np.uint64(0xFFFF)).astype(np.int64)]).tolist():
                for number in self.seeds.get((run, int(w[j])), ()):
                    found.setdefault(number, set()).add(j)
        out = []
        for number, starts in sorted(found.items()):
            item_id, item, run = self.items[number]
            inside = np.zeros(len(h), bool)     # words of the text that any run can use
            for j in starts:
                inside[j:j + run] = True
            keep = inside | np.concatenate(([False], inside[:-1]))    # one word apart at the ends
            doc = np.where(inside, h, np.uint64(0))[keep]
            place = np.flatnonzero(keep)
            tiles = [(i, int(place[j]), n) for i, j, n in tile(item, doc, run)]
            out.append((item_id, sum(n for _, _, n in tiles), len(item), tiles))
        return out


_ROW = "doc_id long, item_id long, covered int, item_words int, tiles array<struct<item_at:int,doc_at:int,words:int>>"
_TILES = pa.list_(pa.struct([("item_at", pa.int32()), ("doc_at", pa.int32()), ("words", pa.int32())]))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[list[tuple[int, str]]]:
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [[(r.item_id, r.text) for r in items.where(block == b).orderBy("item_id", "text").collect()]
            for b in range(n)]


def coverage(docs: DataFrame, benchmark: DataFrame, m: int = MIN_RUN, id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per document row and benchmark item with a shared seed: covered
    and item_words counts, and the tiles as word positions.  Null texts have no
    words; null ids stay null; repeated rows give repeated results."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for items in _blocks(benchmark, item_col, text_col):
        def fn(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items, m)
            for batch in batches:
                ids, got = batch.column(0).to_pylist(), []
                for doc_id, text in zip(ids, batch.column(1).to_pylist()):
                    got += [(doc_id, *x) for x in index.coverage(text)]
                if got:
                    a, b, c, d, e = zip(*got)
                    yield pa.record_batch({
                        "doc_id": pa.array(a, pa.int64()), "item_id": pa.array(b, pa.int64()),
                        "covered": pa.array(c, pa.int32()), "item_words": pa.array(d, pa.int32()),
                        "tiles": pa.array([[dict(item_at=i, doc_at=j, words=n) for i, j, n in t] for t in e],
                                          _TILES)})
        part = rows.mapInArrow(fn, _ROW)
        out = part if out is None else out.unionAll(part)
    return out


def leaks(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``coverage`` whose tiles cover enough of the item."""
    return found.where(F.col("covered") >= F.lit(threshold) * F.col("item_words"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, m: int = MIN_RUN, threshold: float = THRESHOLD,
               text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs``, all columns kept, that no benchmark item contaminates."""
    at = docs.columns.index(text_col)
    for items in _blocks(benchmark, item_col, text_col):
        def fn(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items, m)
            for batch in batches:
                keep = [all(c < threshold * n for _, c, n, _ in index.coverage(t))
                        for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))
        docs = docs.mapInArrow(lean(fn), docs.schema)
    return docs
