"""Token ids in Simple-8b blocks.

Texts are sorted by id over the whole table (range shuffle), encoded, and
written as blocks.  A block holds whole documents: their ids, the number of
token ids of each, and 64-bit words whose top four bits say how the other 60
are cut (selector: count x bits).  Selector 0 is a run of 240 zeros; a value of
61 bits or more is escaped as two words of selector 1 with 32 bits each.  A
block knows where its ids start in its file part, so that any block can be
decoded alone; the starts of the parts are a sum over one number per part.
Decoding gathers the words of each selector with one shift and mask.

The container is Parquet (a row per block, payloads as binary), which any store
that Spark reads can hold; parts ascend by document id, blocks within parts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaystats.llm.byte_bpe import _chunks, marked
from delaystats.llm.common import worker_cache, written
from delaystats.llm.verified_bpe import byte_letters

BLOCK_IDS = 1 << 16         # ids after which a block is closed
CACHED_CHUNKS = 800_000     # encoded text chunks a worker keeps
CACHED_LENGTH = 200         # characters of a chunk that is kept, at most
LIBRARY_CHUNKS = 2000       # chunks the library encodes at a time: its results are large
PIECE_CHARS = 4_000_000     # characters of text encoded at a time (a longer text is a piece)
#: A chunk that is one word, and the letter that stands for each byte.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
_LETTERS = {b: c for c, b in byte_letters().items()}
#: Selector -> (values per word, bits per value).
SELECTORS = ((240, 0), (1, 32), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
             (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 1


def pack(values: np.ndarray) -> np.ndarray:
    """Simple-8b words of unsigned 64-bit values: at each value the selector
    that takes the most of them."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    if not n:
        return np.empty(0, np.uint64)
    bits = np.frexp((v & np.uint64(0xFFFFFFFF)).astype(np.float64))[1].astype(np.uint8)
    high = v >> np.uint64(32)
    if high.any():
        bits = np.where(high, np.frexp(high.astype(np.float64))[1] + 32, bits).astype(np.uint8)
    most = int(bits.max())
    choice = np.full(n, ESCAPE, np.int8)
    for s in range(len(SELECTORS) - 1, -1, -1):     # few values per word first, the best one wins
        count, width = SELECTORS[s]
        if s == ESCAPE or count > n:
            continue
        if width >= most:
            choice[:n - count + 1] = s
            continue
        at = np.flatnonzero(bits <= width)          # runs of values that fit
        first = at[:max(0, len(at) - count + 1)]
        choice[first[at[count - 1:] - first == count - 1]] = s
    counts = np.array([c for c, _ in SELECTORS])
    step = counts[choice].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    at = np.array(starts)
    sel = choice[at]
    size = np.where(sel == ESCAPE, 2, 1)
    place = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(place[-1], np.uint64)
    for s in np.unique(sel):
        count, width = SELECTORS[s]
        which = np.flatnonzero(sel == s)
        head = np.uint64(int(s) << 60)
        if s == ESCAPE:
            x = v[at[which]]
            out[place[which]] = head | (x & np.uint64(0xFFFFFFFF))
            out[place[which] + 1] = head | (x >> np.uint64(32))
        elif width == 0:
            out[place[which]] = head
        else:
            first = at[which]
            word = np.full(len(which), head)
            for lane in range(count):
                word |= v[first + lane] << np.uint64(lane * width)
            out[place[which]] = word
    return out


def unpack(words: np.ndarray) -> np.ndarray:
    """The values of Simple-8b words."""
    w = np.asarray(words, np.uint64)
    sel = (w >> np.uint64(60)).astype(np.int64)
    size = np.array([c for c, _ in SELECTORS])[sel]
    escape = sel == ESCAPE
    second = escape & (np.cumsum(escape) % 2 == 0)
    size[second] = 0
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(at[-1], np.uint64)
    for s in np.unique(sel):
        count, width = SELECTORS[s]
        if s == ESCAPE:
            first = np.flatnonzero(escape & ~second)
            mask = np.uint64(0xFFFFFFFF)
            out[at[first]] = (w[first] & mask) | ((w[first + 1] & mask) << np.uint64(32))
        elif width:
            which = np.flatnonzero(sel == s)
            lanes = np.arange(count)
            x = (w[which][:, None] >> (lanes * width).astype(np.uint64)) & np.uint64((1 << width) - 1)
            out[at[which][:, None] + lanes] = x
    return out


def _of_words(tokenizer_json: str):
    """The library for single words in the letters of a byte-level vocabulary:
    the same model without the steps before it.  None where these steps are other
    than a byte-level split, or an added token could lie in a word."""
    from tokenizers import Tokenizer

    spec = json.loads(tokenizer_json)
    split = spec["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if not plain or spec["normalizer"] or any(_WORD(x["content"]) for x in spec["added_tokens"]):
        return None
    return Tokenizer.from_str(json.dumps(spec | {"pre_tokenizer": None, "added_tokens": []}))


def _encoder(tokenizer_json: str, special_as_text: bool = False):
    """text -> little-endian uint32 ids.  Some PIECE_CHARS of text at a time are
    cut into chunks (see ``_chunks``), numbered by Arrow, and the ids of the
    different ones put where they occur.  A worker keeps the ids of the chunks
    that it met last, so that the library encodes few of them again; chunks that
    are one word go to its model without being split again.  A text that
    holds an added token goes to the library whole, since the library cuts there
    first.  Spark runs a task per core, so the library's own threads stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = worker_cache("tokenizers")
    if (tokenizer_json, special_as_text) not in library:
        t = Tokenizer.from_str(tokenizer_json)
        t.encode_special_tokens = special_as_text
        added = [x.content for x in t.get_added_tokens_decoder().values()]
        library[tokenizer_json, special_as_text] = t, added, [{}, {}]
        worker_cache("tokenizers_of_words")[tokenizer_json] = _of_words(tokenizer_json)
    t, added, met = library[tokenizer_json, special_as_text]
    of_words = worker_cache("tokenizers_of_words")[tokenizer_json]

    def coded(of: Tokenizer, chunks: list[str]) -> Iterator[bytes]:
        for at in range(0, len(chunks), LIBRARY_CHUNKS):
            ids = [e.ids for e in of.encode_batch_fast(chunks[at:at + LIBRARY_CHUNKS], add_special_tokens=False)]
            ends = np.cumsum([4 * len(x) for x in ids]).tolist()
            raw = np.fromiter(chain.from_iterable(ids), "<u4", ends[-1] // 4).tobytes()
            yield from [raw[a:b] for a, b in zip([0, *ends], ends)]

    def ids_of(chunks: list[str]) -> list[bytes]:
        now, before = met
        got = list(map(now.get, chunks))
        unknown = [i for i, x in enumerate(got) if x is None]
        new = [chunks[i] for i in unknown]
        ids = list(map(before.get, new))
        missing = [i for i, x in enumerate(ids) if x is None]
        words = [i for i in missing if _WORD(new[i])] if of_words else []
        if words:
            letters = "\n".join([new[i] for i in words]).encode().decode("latin-1").translate(_LETTERS)
            for i, x in zip(words, coded(of_words, letters.split(_LETTERS[10]))):
                ids[i] = x
            missing = [i for i in missing if ids[i] is None]
        for i, x in zip(missing, coded(t, [new[i] for i in missing])):
            ids[i] = x
        for i, x in zip(unknown, ids):
            got[i] = x
        now.update((c, x) for c, x in zip(new, ids) if len(c) <= CACHED_LENGTH)
        if len(now) > CACHED_CHUNKS // 2:
            met[:] = {}, now
        return got

    def encode(texts: list[str]) -> list[bytes]:
        whole = {i: ids_of([x] if any(a in x for a in added) else _chunks(x)) for i, x in enumerate(texts)
                 if "\0" in x or any(a in x for a in added)}
        cut = pc.split_pattern(pa.array(["" if i in whole else marked(x) for i, x in enumerate(texts)],
                                        pa.large_string()), "\0")
        coded = cut.flatten().dictionary_encode()
        number = np.asarray(coded.indices)
        raw = ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        starts, size = np.cumsum(sizes) - sizes, sizes[number]
        ends = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(starts[number] - ends[:-1], size) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(raw), "<u4")[at].tobytes()
        ends = (4 * ends[np.asarray(cut.offsets)]).tolist()
        return [b"".join(whole[i]) if i in whole else ids[a:b] for i, (a, b) in enumerate(zip(ends, ends[1:]))]

    def pieces(texts: list[str]) -> Iterator[bytes]:
        start = size = 0
        for i, x in enumerate(texts):
            size += len(x)
            if size >= PIECE_CHARS:
                yield from encode(texts[start:i + 1])
                start, size = i + 1, 0
        yield from encode(texts[start:])
    return pieces


_BLOCK = ("part int, block int, part_start long, n_ids long, doc_ids array<long>, counts array<int>, data binary")


def _block_rows(tokenizer_json: str, end_id: int, special_as_text: bool):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = _encoder(tokenizer_json, special_as_text)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        ids, raw, total, block, start = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            counts = [len(x) // 4 for x in raw]
            data = pack(np.frombuffer(b"".join(raw), "<u4")).astype("<u8").tobytes()
            return pa.record_batch({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                "part_start": pa.array([start], pa.int64()), "n_ids": pa.array([total], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int32())),
                "data": pa.array([data], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                for doc_id, x in zip(piece.column(0).to_pylist(),
                                     encode([t or "" for t in piece.column(1).to_pylist()])):
                    ids.append(doc_id)
                    raw.append(x + end)
                    total += len(x) // 4 + 1
                    if total >= BLOCK_IDS:
                        yield close()
                        ids, raw, total, block, start = [], [], 0, block + 1, start + total
        if ids:
            yield close()
    return fn


def write_ids(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> str:
    """Write the ids of every row, ``end_id`` after each, in ascending id order.

    The strings of added tokens get those tokens' ids, as in the library, or
    with ``special_as_text`` the ids of their characters.

    Null text is empty (the end id alone); null ids come first; rows with the
    same id are ordered by a hash of their text, and an id with very many rows
    is spread over parts by it.  Other columns are left out.  An empty table
    gives an empty file.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer_json = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(_block_rows(tokenizer_json, end_id, special_as_text), _BLOCK).write.parquet(path))
    return path


def _doc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            raw = unpack(np.frombuffer(row["data"], "<u8")).astype("<u4").tobytes()
            ends = np.concatenate(([0], np.cumsum(row["counts"]))).tolist()
            yield pa.record_batch({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "start": pa.array([row["start"] + e for e in ends[:-1]], pa.int64()),
                "ids": pa.array([raw[4 * a:4 * b] for a, b in zip(ends, ends[1:])], pa.binary())})


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document: ids as little-endian uint32,
    start the number of ids of all documents before it."""
    blocks = spark.read.schema(_BLOCK).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    starts = written(starts, "starts")          # a row per part: small enough to be seen as small
    return (blocks.join(starts, "part")
            .select("doc_ids", "counts", "data", (F.col("first") + F.col("part_start")).alias("start"))
            .mapInArrow(_doc_rows, "doc_id long, start long, ids binary"))
