"""Byte-level BPE: ranked merges folded by Spark's higher-order functions.

Words (matches of the split pattern) repeat, so a block of texts is reduced to
its distinct words first: an Arrow pass writes, per block of at most BLOCK_CHARS
of text, one row with the byte arrays of its distinct words, less those that
earlier blocks of its task had (up to TASK_WORDS), and, per document, the
numbers of its words.  On that row Spark expressions encode every word:

* A merge makes one token of two, and that token's id is its rank.  The rank
  map is a literal: row displacement puts the merges of all left tokens into
  one array, so that the rank of a pair is one addition and one XOR away.
* The state of the fold is one array: token, rank of the pair with the next,
  next token, ...; tokens lie above all ranks, so array_min finds the merge of
  lowest rank and array_position its leftmost place.  A step replaces the two
  tokens and looks up the two ranks that change, until no pair has one.
* The distinct words of a bounded sample of texts (the most frequent
  CACHE_WORDS of them) are folded once beforehand and go to the Arrow passes.
  This only saves time: any other word is folded in its block.

A second Arrow pass puts the words' ids together per document.  Nothing is
shuffled, so blocks arrive in the order in which they were made, and a block,
the known words, TASK_WORDS and the largest text bound the memory.
Decoding looks up each id's binary piece (as hex) and concatenates them.
"""

from __future__ import annotations

import base64
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import hash_sample, lean

CACHE_WORDS = 200_000       # words folded beforehand, at most
CACHE_TEXTS = 10_000        # texts whose words are counted for them
BLOCK_CHARS = 2_000_000     # characters of text per block (a longer text is a block)
TASK_WORDS = 300_000        # words of earlier blocks that a task knows, before it starts anew
BATCH_TEXTS = 500           # texts taken from a batch at a time
_CUT = re.compile(r" (?=\S)")
_SPACES = re.compile(r" (?:\s|\Z)")
_MARKS = re.compile("[.,](?<![0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff][.,])")
_LINES = re.compile(r"\n(?<=\s\n)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank (= id) of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: ranked merges run over its
    own bytes until two parts are left.  A token comes about in no other way:
    no merge crosses its ends, and inside them the merges are always the same."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        i = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 40))
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def _displaced(merges: list[tuple[int, int, int]], base: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, cells) with cells[first[a] + b] ^ (a << bits) = m for every merge
    (a, b, m) and at least ``base`` = 1 << bits for any other pair; a and b count
    from ``base``.  Each left token's merges get a place where all cells are free."""
    bits = base.bit_length() - 1
    rows = defaultdict(list)
    for a, b, m in merges:
        rows[a].append((b, m))
    n = 4 * len(merges) + 256
    free, cells, first = np.ones(n + base, bool), np.zeros(n + base, np.int64), np.zeros(2 * base, np.int64)
    for a in sorted(rows, key=lambda a: (-len(rows[a]), a)):
        b, m = np.array(rows[a], np.int64).T
        low = b.min()
        fits = np.ones(n, bool)
        for x in b - low:
            fits &= free[x:x + n]
        first[a + base] = fits.argmax() - low
        at = first[a + base] + b
        free[at], cells[at] = False, ((a + base) << bits) | m
    end = int(np.flatnonzero(~free).max(initial=0)) + 1
    return first, np.concatenate((np.zeros(base, np.int64), cells[:end], np.zeros(base, np.int64)))


class ByteBpe:
    """Encoder and decoder of one rank file; columns in, columns out."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        size = max(ranks.values()) + 1
        self.base = 1 << size.bit_length()      # a token in the fold is its id + base
        merges = [(ranks[a], ranks[b], m) for t, m in ranks.items() if len(t) > 1
                  for a, b in (last_merge(t, ranks),)]
        self.first, self.cells = _displaced(merges, self.base)
        del merges
        self.byte_tokens = np.array([ranks[bytes([b])] for b in range(256)], np.int64) + self.base
        self.end = 2 * self.base - 1            # stands before and after a word and merges with nothing
        pieces = [""] * size
        for t, r in ranks.items():
            pieces[r] = t.hex()
        self.pieces = F.split(F.lit(" ".join(pieces)), " ")
        self.known = pa.table({"word": pa.array([], pa.string()), "ids": pa.array([], pa.list_(pa.int32()))})

    def with_map(self, df: DataFrame) -> DataFrame:
        """``df`` with the rank map in ``_first`` and ``_cells``: literals that
        Spark puts in when the plan runs (scalars of a local table), once for
        all their uses and not into the plan's text."""
        one = df.sparkSession.createDataFrame([(self.first.tolist(), self.cells.tolist())],
                                              "first array<bigint>, cells array<bigint>")
        return df.withColumns({"_first": one.select("first").scalar(), "_cells": one.select("cells").scalar()})

    def folded(self, work) -> Column:
        """``work(map)`` on a frame ``with_map``.  Each column of the map is
        named once, so that Spark puts the scalar in its place; named more
        often, it would be copied into every row."""
        return F.transform(F.array(F.struct("_first", "_cells")), work)[0]

    def rank(self, ranks: Column, a: Column, b: Column) -> Column:
        """Rank of a pair of tokens, ``base`` or more if it does not merge."""
        return ranks["_cells"][ranks["_first"][a] + b].bitwiseXOR(F.shiftleft(a, self.base.bit_length() - 1))

    def fold(self, ranks: Column, word: Column) -> Column:
        """Token ids of one word (an array of the tokens of its bytes between
        two ends): the ranked merges of the map folded over it."""
        base = F.lit(self.base).cast("bigint")

        def merged(s: Column, at: Column) -> Column:
            token = s[at - 1] + base
            return F.concat(F.slice(s, F.lit(1), at - 3),
                            F.array(self.rank(ranks, s[at - 4], token), token, self.rank(ranks, token, s[at + 2])),
                            F.slice(s, at + 3, F.size(s)))

        def step(s: Column, _) -> Column:
            least = F.array_min(s)
            place = F.array(F.array_position(s, least).cast("int"))
            return F.call_function("if", least < base, F.aggregate(place, s, merged), s)

        pairs = F.zip_with(word, F.slice(word, F.lit(2), F.size(word)), lambda a, b: F.array(a, self.rank(ranks, a, b)))
        return F.aggregate(F.slice(word, F.lit(4), F.size(word) - 3), F.flatten(pairs), step, lambda s: F.transform(
            F.sequence(F.lit(3), F.size(s) - 3, F.lit(2)), lambda i: (s[i - 1] - base).cast("int")))

    def learn_words(self, docs: DataFrame) -> ByteBpe:
        """Fold the frequent distinct words of a bounded sample beforehand."""
        ids = hash_sample(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", CACHE_TEXTS, 5)
        sample = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text")
        words = (sample.mapInArrow(lean(_word_counts(self.pattern)), "word string, n long")
                 .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(CACHE_WORDS))
        known = (words.repartition(docs.sparkSession.sparkContext.defaultParallelism)
                 .mapInArrow(_word_bytes(self.byte_tokens, self.end), "word string, bytes array<long>"))
        ids = self.folded(lambda ranks: self.fold(ranks, F.col("bytes")))
        self.known = self.with_map(known).select("word", ids.alias("ids")).toArrow()
        return self

    def encode(self, docs: DataFrame) -> DataFrame:
        """(doc_id, ids) of (doc_id, text) rows."""
        ids = self.known.column("ids").combine_chunks()
        known = self.known.column("word").to_pylist(), ids.flatten().to_numpy(), ids.value_lengths().to_numpy()
        blocks = docs.mapInArrow(lean(_blocks(self.pattern, known[0], self.byte_tokens, self.end)),
                                 "doc_ids array<long>, words array<array<long>>, counts array<int>, numbers binary, "
                                 "fresh boolean")
        tokens = self.folded(lambda ranks: F.transform("words", lambda word: self.fold(ranks, word)))
        return (self.with_map(blocks).select("doc_ids", "counts", "numbers", tokens.alias("tokens"), "fresh")
                .mapInArrow(lean(_documents(*known[1:])), "doc_id long, ids array<int>"))

    def decode(self, ids: Column) -> Column:
        """binary: the concatenated pieces of the ids; null or empty ids give
        an empty value, an id without a piece fails."""
        got = F.transform(F.coalesce(ids, F.array().cast("array<int>")), lambda i: F.element_at(self.pieces, i + 1))
        return F.unhex(F.array_join(got, ""))


def marked(text: str) -> str:
    """The text, which has no NUL, with a NUL at places that a word never spans,
    so that few different chunks between them make up many texts: before every
    single space that a non-space follows, and, where that holds for all of the
    text, before full stops and commas after a letter or digit and before line
    ends after a non-space."""
    out = _CUT.sub("\0 ", text) if _SPACES.search(text) else text.replace(" ", "\0 ")
    if not _MARKS.search(text):
        out = out.replace(".", "\0.").replace(",", "\0,")
    return out if _LINES.search(text) else out.replace("\n", "\0\n")


def _chunks(text: str) -> list[str]:
    """The text cut where ``marked`` marks it."""
    if "\0" not in text:
        return marked(text).split("\0")
    first, *parts = _CUT.split(text)
    return [first, *[" " + p for p in parts]]


def _word_counts(pattern: str):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern).findall
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                counts.update(split(text or ""))
            yield pa.record_batch({"word": pa.array(list(counts), pa.string()),
                                   "n": pa.array(list(counts.values()), pa.int64())})
    return fn


def _byte_arrays(words: list[str], byte_tokens: np.ndarray, end: int) -> pa.ListArray:
    """The tokens of the bytes of each word, with an end on either side."""
    raw = [w.encode() for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 2
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    inner = np.ones(offsets[-1], bool)
    inner[offsets[:-1]] = inner[offsets[1:] - 1] = False
    out = np.full(offsets[-1], end, np.int64)
    out[inner] = byte_tokens[np.frombuffer(b"".join(raw), np.uint8)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out))


def _word_bytes(byte_tokens: np.ndarray, end: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"word": batch.column(0),
                                   "bytes": _byte_arrays(batch.column(0).to_pylist(), byte_tokens, end)})
    return fn


def _blocks(pattern: str, known: list[str], byte_tokens: np.ndarray, end: int):
    """Words are numbered: the known ones first, then the others as they come.  A
    block has those that no earlier one had since the last ``fresh`` block."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern).findall
        first = {w: i for i, w in enumerate(known)}

        def flush() -> pa.RecordBatch:
            offsets = pa.array([0, len(ids)], pa.int32())
            new = _byte_arrays(list(islice(words, sent, None)), byte_tokens, end)
            return pa.record_batch({
                "doc_ids": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64())),
                "words": pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), new),
                "counts": pa.ListArray.from_arrays(offsets, pa.array([len(x) // 4 for x in numbers], pa.int32())),
                "numbers": pa.array([b"".join(numbers)], pa.binary()),
                "fresh": pa.array([sent == len(first)])})

        words: dict[str, int] = dict(first)
        sent = len(first)
        chunks: dict[str, bytes] = {}
        ids: list = []
        numbers: list[bytes] = []
        size = 0
        for doc_id, text in (x for b in batches for at in range(0, b.num_rows, BATCH_TEXTS)
                             for x in zip(*(c.to_pylist() for c in b.slice(at, BATCH_TEXTS).columns))):
            cut = _chunks(text or "")
            for c in set(cut).difference(chunks):
                chunks[c] = np.array([words.setdefault(w, len(words)) for w in split(c)], "<i4").tobytes()
            ids.append(doc_id)
            numbers.append(b"".join(map(chunks.__getitem__, cut)))
            size += len(text or "")
            if size >= BLOCK_CHARS:
                yield flush()
                ids, numbers, size, sent = [], [], 0, len(words)
                if max(sent - len(first), len(chunks)) >= TASK_WORDS:
                    words, sent, chunks = dict(first), len(first), {}
        if ids:
            yield flush()
    return fn


def _documents(known_ids: np.ndarray, known_sizes: np.ndarray):
    def pieces(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        raw, at = ids.astype("<i4").tobytes(), [0, *(np.cumsum(sizes, dtype=np.int64) * 4).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = pieces(known_ids, known_sizes)
        for batch in batches:
            doc_ids, counts, numbers, tokens, fresh = (batch.column(i) for i in range(5))
            for row in range(batch.num_rows):
                if fresh[row].as_py():
                    word_ids, sizes = list(first), known_sizes.astype(np.int64)
                new = tokens[row].values
                word_ids += pieces(new.flatten().to_numpy(), new.value_lengths().to_numpy())
                sizes = np.concatenate((sizes, new.value_lengths().to_numpy()))
                number = np.frombuffer(numbers[row].as_py(), "<i4")
                text_ids = np.frombuffer(b"".join(map(word_ids.__getitem__, number.tolist())), "<i4")
                total = np.concatenate(([0], np.cumsum(sizes[number])))
                cut = total[np.concatenate(([0], np.cumsum(counts[row].values.to_numpy())))]
                yield pa.record_batch({"doc_id": doc_ids[row].values,
                                       "ids": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(text_ids))})
    return fn


def encoded(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and token ids of every row.  Null text counts as empty (no ids),
    null ids stay null, repeated rows are encoded each, other columns are left
    out, and an empty table gives an empty result."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return bpe.learn_words(rows).encode(rows)
