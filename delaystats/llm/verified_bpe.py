"""Byte-level BPE by speculation and verification.

Exact BPE merges pair by pair.  Here a word's tokens are first *guessed* by
greedy longest match, all words of a batch at once (a trie of the vocabulary in
sorted arrays, one byte of every word a step).  The guess is the encoding if

* every token encodes to itself, which is tested once per vocabulary; others
  are never proposed; and
* every two neighbours are *compatible*: encoding their joint bytes gives the
  same two tokens.  No merge may cross the border, so the merges along the
  right edge of the first and the left edge of the second are undone, latest
  first, and at each stage the pair at the border must have no merge that
  would have come before the one just undone.  All pairs of a batch are walked
  together.

Only words with an incompatible pair are merged exactly: words of like length
together, one merge of each a round, and very long ones by a heap over ranks
and places.  A word's ids are kept by the worker while its cache has room, which
only saves time.  Texts are cut at added tokens first, as the library does.
Nothing is shuffled: an Arrow pass encodes, another decodes.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystats.llm.byte_bpe import _chunks
from delaystats.llm.common import worker_cache

NEVER = np.int64(1) << 40       # rank of a pair that does not merge
LONG = 256                      # bytes of a word that goes to the heap at once
CACHED_CHUNKS = 600_000         # encoded pieces of text a worker keeps
BATCH_TEXTS = 1000
CELLS = 500_000                 # token cells of a block of words that are merged together
#: Fixed value: the split of byte-level BPE into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of text are split together, with this character between them.
BORDER = "\ue000"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the others counted on from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def token_bytes(token: str, letters: dict[str, int]) -> bytes:
    try:
        return bytes(letters[c] for c in token)
    except KeyError:
        return token.encode()


@dataclass
class Tables:
    """A vocabulary as arrays; ids index ``pieces``, ``made``, ``left``, ``right``."""

    pieces: list                # bytes of each id (None: no such id)
    added: list                 # (text, id) of added tokens
    byte_ids: np.ndarray        # id of each byte
    pair_keys: np.ndarray       # sorted left << 32 | right
    pair_ranks: np.ndarray
    pair_ids: np.ndarray        # id of the merged token
    made: np.ndarray            # rank of the merge that makes a token, -1 for a byte
    left: np.ndarray
    right: np.ndarray
    edges: np.ndarray           # sorted state << 8 | byte of the trie
    targets: np.ndarray         # state after the edge
    accepts: np.ndarray         # id that ends in a state, or -1
    byte_ranks: np.ndarray      # rank of every pair of bytes; 256 stands for none

def read_tables(tokenizer_json: str) -> Tables:
    """Tables of a byte-level BPE file; features that would change the result
    and that are not built here are refused."""
    spec = json.loads(tokenizer_json)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    refused = (spec["normalizer"], model.get("dropout"), model.get("unk_token"), model.get("continuing_subword_prefix"),
               model.get("end_of_word_suffix"), model.get("ignore_merges"), split.get("add_prefix_space"))
    plain = all(not t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
    if any(refused) or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or not plain:
        raise ValueError("only plain byte-level BPE files are supported")
    letters = byte_letters()
    vocab = model["vocab"]
    added = [(t["content"], t["id"]) for t in spec["added_tokens"]]
    size = max([*vocab.values(), *(i for _, i in added)]) + 1
    pieces: list = [None] * size
    for t, i in [*vocab.items(), *added]:
        pieces[i] = token_bytes(t, letters)
    byte_ids = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    a = np.array([vocab[x] for x, _ in merges], np.int64)
    b = np.array([vocab[y] for _, y in merges], np.int64)
    m = np.array([vocab[x + y] for x, y in merges], np.int64)
    rank = np.arange(len(merges))
    made, left, right = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    made[m], left[m], right[m] = rank, a, b
    # undoing merges latest first needs one merge per token, its parts made before it
    if len(set(m.tolist())) != len(m) or (made[a] >= rank).any() or (made[b] >= rank).any():
        raise ValueError("merges out of order")
    order = np.argsort(a << 32 | b)
    byte_ranks = np.full((257, 257), NEVER)
    byte_of = {i: n for n, i in enumerate(byte_ids.tolist())}
    for x, y, r in zip(a.tolist(), b.tolist(), rank.tolist()):
        if x in byte_of and y in byte_of:
            byte_ranks[byte_of[x], byte_of[y]] = r
    tables = Tables(pieces, added, byte_ids, (a << 32 | b)[order], rank[order], m[order], made, left, right,
                    np.empty(0), np.empty(0), np.empty(0), byte_ranks)
    exact = Exact(tables)
    stable = [i for t, i in vocab.items() if (made[i] >= 0 or len(pieces[i]) == 1) and exact(pieces[i]) == [i]]
    accept, edges = [-1], {}
    for i in stable:
        state = 0
        for byte in pieces[i]:
            key = state << 8 | byte
            if key not in edges:
                edges[key] = len(accept)
                accept.append(-1)
            state = edges[key]
        accept[state] = i
    tables.edges = np.array(sorted(edges), np.int64)
    tables.targets = np.array([edges[k] for k in sorted(edges)], np.int64)
    tables.accepts = np.array(accept, np.int64)
    return tables


class Exact:
    """Ranked merging of one word: n log n steps for n bytes."""

    def __init__(self, t: Tables):
        keys = t.pair_keys.tolist()
        self.merges = dict(zip(keys, zip(t.pair_ranks.tolist(), t.pair_ids.tolist())))
        self.byte_ids = t.byte_ids.tolist()

    def __call__(self, word: bytes) -> list[int]:
        ids, merges = [self.byte_ids[b] for b in word], self.merges
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, found[1]) for i in range(n - 1)
                if (found := merges.get(ids[i] << 32 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, merged = heapq.heappop(heap)
            j = after[i]
            # stale if either side has changed since
            if ids[i] < 0 or j >= n or (found := merges.get(ids[i] << 32 | ids[j])) is None or found[1] != merged:
                continue
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get(merged << 32 | ids[k]):
                    heapq.heappush(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get(ids[h] << 32 | merged)):
                heapq.heappush(heap, (found[0], h, found[1]))
        return [x for x in ids if x >= 0]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def _spans(flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Consecutive runs of ids as little-endian 32-bit integers."""
    raw, ends = flat.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def merge_rows(t: Tables, words: list[bytes]) -> list[bytes]:
    """Ranked merging of many words of like length: each round makes the merge
    of lowest rank, the leftmost of equals, in every word that has one."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max())
    inside = np.arange(width) < sizes[:, None]
    raw = np.full((len(words), width + 1), 256, np.int64)
    raw[:, :-1][inside] = np.frombuffer(b"".join(words), np.uint8)
    # the column behind the last one stays empty, so that every token has a neighbour
    ids = np.append(t.byte_ids, -1)[raw]
    ranks = t.byte_ranks[raw[:, :-1], raw[:, 1:]]

    def ranks_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where((a >= 0) & (b >= 0), _lookup(t.pair_keys, t.pair_ranks, a << 32 | b, NEVER), NEVER)

    merged = np.empty(len(t.pair_ids), np.int64)
    merged[t.pair_ranks] = t.pair_ids
    done = np.full((len(words), width), -1, np.int32)
    live, column = np.arange(len(words)), np.arange(width)
    while True:
        at = ranks.argmin(axis=1)
        rows = np.arange(len(live))
        best = ranks[rows, at]
        over = best == NEVER
        if over.any():
            done[live[over]] = ids[over, :width]
            go = ~over
            live, ids, ranks, at, best = live[go], ids[go], ranks[go], at[go], best[go]
            rows = np.arange(len(live))
        if not len(live):
            break
        ids[rows, at] = merged[best]
        source = column + (column > at[:, None])        # the right part of the merge goes, the rest moves up
        ids[:, :-1] = np.take_along_axis(ids, source, axis=1)
        ranks[:, :-1] = np.take_along_axis(ranks, source[:, :-1], axis=1)
        ranks[:, -1] = NEVER
        ranks[rows, at] = ranks_of(ids[rows, at], ids[rows, at + 1])
        before = np.maximum(at - 1, 0)
        ranks[rows, before] = np.where(at > 0, ranks_of(ids[rows, before], ids[rows, before + 1]), ranks[rows, before])
    return _spans(done[done >= 0], (done >= 0).sum(axis=1))


def propose(t: Tables, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy longest match of every word text[start:end]: (word number, id) of
    each token, words ascending and tokens in order."""
    words, ids = [], []
    word, at = np.arange(len(starts)), starts.astype(np.int64)
    while len(word):
        state, place = np.zeros(len(word), np.int64), at.copy()
        best, best_end = np.full(len(word), -1, np.int64), at.copy()
        live = np.arange(len(word))
        while len(live):
            state = _lookup(t.edges, t.targets, state << 8 | text[place], -1)
            found = state >= 0
            live, state, place = live[found], state[found], place[found] + 1
            token = t.accepts[state]
            took = token >= 0
            best[live[took]], best_end[live[took]] = token[took], place[took]
            more = place < ends[word[live]]
            live, state, place = live[more], state[more], place[more]
        words.append(word)
        ids.append(best)
        rest = best_end < ends[word]
        word, at = word[rest], best_end[rest]
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    number, ids = np.concatenate(words), np.concatenate(ids)
    order = np.argsort(number, kind="stable")
    return number[order], ids[order]


def compatible(t: Tables, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of tokens: does encoding their joint bytes give them back?"""
    pairs, back = np.unique(a << 32 | b, return_inverse=True)
    ok = np.ones(len(pairs), bool)
    live, u, v = np.arange(len(pairs)), pairs >> 32, pairs & 0xFFFFFFFF
    limit = np.full(len(pairs), NEVER)
    while len(live):
        crossed = _lookup(t.pair_keys, t.pair_ranks, u << 32 | v, NEVER) < limit
        ok[live[crossed]] = False
        made_u, made_v = t.made[u], t.made[v]
        go = ~crossed & ((made_u >= 0) | (made_v >= 0))
        live, u, v, made_u, made_v = live[go], u[go], v[go], made_u[go], made_v[go]
        # of two equal merges the left one comes first, so the right one is undone first
        first = made_u > made_v
        limit = np.where(first, made_u, made_v + 1)
        u, v = np.where(first, t.right[u], u), np.where(first, v, t.left[v])
    return ok[back]


class Encoder:
    """Token ids of texts, by one worker."""

    def __init__(self, t: Tables):
        import regex
        from tokenizers import pre_tokenizers

        self.tables, self.exact = t, Exact(t)
        bordered = PATTERN.replace("[^\\s\\p{L}\\p{N}]", f"[^\\s\\p{{L}}\\p{{N}}{BORDER}]").replace(
            "(?!\\S)", f"(?![^\\s{BORDER}])")
        self.split = regex.compile(f"{BORDER}|{bordered}").findall
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.added = {x: np.array([i], "<u4").tobytes() for x, i in t.added}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}
        self.merged = 0         # words that had to be merged exactly

    def words_of(self, chunks: list[str]) -> list[list[str]]:
        """The words of pieces of text.  Latin ones are split together; beyond
        them the library's own splitter decides, as its character classes are
        the ones that count."""
        out: list = [None] * len(chunks)
        latin = []
        for i, c in enumerate(chunks):
            if c.isascii() or max(c) < "\u0250":
                latin.append(i)
            else:
                out[i] = [c[a:b] for _, (a, b) in self.library.pre_tokenize_str(c)]
        flat = self.split(BORDER.join([chunks[i] for i in latin]))
        flat.append(BORDER)
        at = 0
        for i in latin:
            end = flat.index(BORDER, at)
            out[i] = flat[at:end]
            at = end + 1
        return out

    def words(self, words: Sequence[str]) -> list[bytes]:
        """Ids of each word: guessed, verified, and merged where the guess fails."""
        t, raw = self.tables, [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list = [None] * len(raw)
        for i in np.flatnonzero(sizes > LONG).tolist():
            out[i] = np.array(self.exact(raw[i]), "<u4").tobytes()
            self.merged += 1
        short = np.flatnonzero(sizes <= LONG)
        lengths = sizes[short]
        ends = np.cumsum(lengths)
        text = np.frombuffer(b"".join([raw[i] for i in short.tolist()]), np.uint8).astype(np.int64)
        number, ids = propose(t, text, ends - lengths, ends)
        same = number[1:] == number[:-1]
        bad = np.zeros(len(short), bool)
        bad[number[1:][same][~compatible(t, ids[:-1][same], ids[1:][same])]] = True
        bad[number[ids < 0]] = True
        good = short[~bad].tolist()
        for i, x in zip(good, _spans(ids[~bad[number]], np.bincount(number, minlength=len(short))[~bad])):
            out[i] = x
        failed = short[bad]
        self.merged += len(failed)
        failed = failed[np.argsort(sizes[failed], kind="stable")]
        at = 0
        while at < len(failed):         # words of like length, in blocks of bounded size
            longest = int(sizes[failed[at]]) * 5 // 4
            upto = min(int(np.searchsorted(sizes[failed], longest, side="right")), at + max(1, CELLS // longest))
            block = failed[at:upto].tolist()
            for i, x in zip(block, merge_rows(t, [raw[i] for i in block])):
                out[i] = x
            at = upto
        return out

    def chunks(self, chunks: list[str]) -> dict[str, bytes]:
        if not chunks:
            return {}
        split = self.words_of(chunks)
        words = list(set(chain.from_iterable(split)))
        got = dict(zip(words, self.words(words)))
        return {c: got[ws[0]] if len(ws) == 1 else b"".join(map(got.__getitem__, ws)) for c, ws in zip(chunks, split)}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        # added tokens come out as every second part
        parts = [self.cut.split(x) if any(a in x for a in self.added) else [x] for x in texts]
        cut = [[_chunks(p) if i % 2 == 0 else p for i, p in enumerate(x)] for x in parts]
        known = self.known
        missing = set().union(*(c for x in cut for c in x[::2])).difference(known)
        known.update(self.chunks(list(missing)))
        get = known.__getitem__
        got = [b"".join([self.added[c] if i % 2 else b"".join(map(get, c)) for i, c in enumerate(x)]) for x in cut]
        full = len(known) > CACHED_CHUNKS
        for c in missing:       # what there is no room for was known for this call only
            if full or len(c) > LONG:
                del known[c]
        return got


def _encoder(tables: Tables) -> Encoder:
    cache = worker_cache("verified_bpe")
    key = (len(tables.pieces), tables.pair_keys.tobytes().__hash__(), tuple(tables.added))
    if key not in cache:
        cache[key] = Encoder(tables)
    return cache[key]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _encoded(tables: Tables, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    encoder = _encoder(tables)
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_TEXTS):
            piece = batch.slice(at, BATCH_TEXTS)
            yield piece.column(0), encoder([x or "" for x in piece.column(1).to_pylist()])


def _decoded(tables: Tables, ids: Iterator[bytes | None]) -> list[str]:
    pieces = [p or b"" for p in tables.pieces]
    number = [np.frombuffer(x or b"", "<u4") for x in ids]
    return [b"".join(map(pieces.__getitem__, x[x < len(pieces)].tolist())).decode("utf-8", "replace") for x in number]


def encode(docs: DataFrame, tables: Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row, ids as little-endian 32-bit integers.

    Null text counts as empty (no ids), null ids stay null, repeated rows are
    encoded each, other columns are left out, and an empty table gives an empty
    result.  Texts of any length are encoded whole.
    """
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids in _encoded(tables, batches):
            yield pa.record_batch([doc_ids, pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(fn, "doc_id long, ids binary")


def decode(rows: DataFrame, tables: Tables) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids): the pieces of all ids joined and
    read as UTF-8, bytes that are none replaced.  Ids without a piece are left
    out, null ids count as none."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _decoded(tables, batch.column(1).to_pylist())
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(fn, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, tables: Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): ``decode`` of ``encode`` by the same worker."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids in _encoded(tables, batches):
            yield pa.record_batch([doc_ids, pa.array(ids, pa.binary()), pa.array(_decoded(tables, ids), pa.string())],
                                  ["doc_id", "ids", "text"])

    return _texts(docs, id_col, text_col).mapInArrow(fn, "doc_id long, ids binary, text string")
