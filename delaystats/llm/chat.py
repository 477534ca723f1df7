"""Chat formatting at the level of token ids.

Every turn is a list of segments: reserved ids (turn marks, outside the
tokenizer's vocabulary) and texts, encoded each by itself, so no token ever
spans a mark and a text can't forge one.  Control strings inside a text are
escaped all the same: a backslash after their first character, and every
backslash doubled, which is undone by reading a backslash with the character
after it as that character.

    <s> at the start of a conversation
    <<SYS>> text <</SYS>>          system
    [INST] text [/INST]            user
    text </s>                      assistant, text under the loss mask
    <|turn|> role <|sep|> text <|/turn|>    any other role

Turns are encoded where they lie, then shuffled by conversation, sorted by
turn, and assembled as a stream: the loss mask is the prefix sum of +1 and -1
at the ends of the assistant segments.  A conversation is written in pieces of
at most PIECE_IDS ids (a longer turn is a piece), so one of any length is
assembled, and read back, in bounded memory.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import worker_cache

PIECE_IDS = 1 << 16
#: The template's control strings, in the order of their reserved ids.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|turn|>", "<|sep|>", "<|/turn|>")
_FIND = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)) + r"|\\")
_UNDO = re.compile(r"\\(.)", re.DOTALL)
_TURN = "conv_id long, turn long, role string, tie long, ids array<int>, loss array<int>"
_PIECE = "conv_id long, piece long, ids array<int>, loss_mask array<tinyint>"
_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def escape(text: str) -> str:
    return _FIND.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNDO.sub(r"\1", text)


def _library(tokenizer_json: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
    from tokenizers import Tokenizer

    kept = worker_cache("chat")
    if tokenizer_json not in kept:
        t = Tokenizer.from_str(tokenizer_json)
        t.encode_special_tokens = True
        kept[tokenizer_json] = t
    return kept[tokenizer_json], kept[tokenizer_json].get_vocab_size()


def segments(role: str | None, text: str) -> list[tuple[str | int, int]]:
    """(control number or text, 1 if under the loss mask) of one turn."""
    if role == "system":
        return [(4, 0), (text, 0), (5, 0)]
    if role == "user":
        return [(2, 0), (text, 0), (3, 0)]
    if role == "assistant":
        return [(text, 1), (1, 0)]
    return [(6, 0), (role or "", 0), (7, 0), (text, 0), (8, 0)]


def _turn_rows(tokenizer_json: str):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, base = _library(tokenizer_json)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                turns = [segments(r, x or "") for r, x in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                texts = [escape(s) for turn in turns for s, _ in turn if isinstance(s, str)]
                encoded = iter(t.encode_batch(texts, add_special_tokens=False))
                ids, loss = [], []
                for turn in turns:
                    row, bounds = [], []
                    for s, masked in turn:
                        got = next(encoded).ids if isinstance(s, str) else [base + s]
                        if masked:
                            bounds += [len(row), len(row) + len(got)]
                        row += got
                    ids.append(row)
                    loss.append(bounds)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), part.column(4),
                     pa.array(ids, pa.list_(pa.int32())), pa.array(loss, pa.list_(pa.int32()))],
                    names=["conv_id", "turn", "role", "tie", "ids", "loss"])
    return fn


def _piece_rows(bos: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        at, piece, ids, bounds = nothing, 0, [], []

        def close() -> pa.RecordBatch:
            delta = np.zeros(len(ids) + 1, np.int8)
            for i, b in enumerate(bounds):
                delta[b] += -1 if i % 2 else 1
            mask = np.cumsum(delta[:-1], dtype=np.int8)
            return pa.record_batch({
                "conv_id": pa.array([at], pa.int64()), "piece": pa.array([piece], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int32())),
                "loss_mask": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(mask))})

        for batch in batches:
            for conv, row, loss in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at is nothing or conv != at:
                    if ids:
                        yield close()
                    at, piece, ids, bounds = conv, 0, [bos], []
                elif len(ids) >= PIECE_IDS:
                    yield close()
                    piece, ids, bounds = piece + 1, [], []
                bounds += [len(ids) + b for b in loss]
                ids += row
        if ids:
            yield close()
    return fn


def format_chats(turns: DataFrame, tokenizer_json: str, vocabulary: int) -> DataFrame:
    """Pieces of every conversation: conv_id, piece, ids, loss_mask.

    Turns go by number; equal numbers by role, then a hash of the text.  Null
    text is empty, a null role an empty one; turns without a number come first
    and rows without a conversation id form one conversation.  Columns beyond
    conv_id, turn, role and text are left out.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                        F.xxhash64("text").alias("tie"))
    encoded = rows.mapInArrow(_turn_rows(tokenizer_json), _TURN)
    order = ["conv_id", "turn", "role", "tie"]
    return (encoded.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "ids", "loss")
            .mapInArrow(_piece_rows(vocabulary), _PIECE))


def _digest_rows(tokenizer_json: str):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, base = _library(tokenizer_json)
        nothing = object()
        at = nothing
        roles = {5: "system", 3: "user", 1: "assistant"}

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{
                "conv_id": at, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars,
                "loss_sha256": loss.hexdigest(), "formatted_chars": chars}], schema=pa.schema([
                    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

        for batch in batches:
            for conv, ids, mask in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at is nothing or conv != at:
                    if at is not nothing:
                        yield row()
                    at, n, chars, loss_chars = conv, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                marks = [i for i, x in enumerate(ids) if x >= base]
                before, role = -1, None
                for i in marks:         # a piece ends with a turn, so with a mark
                    written = t.decode(ids[before + 1:i], skip_special_tokens=False) if i > before + 1 else ""
                    masked = any(mask[before + 1:i])
                    control = ids[i] - base
                    chars += len(written) + len(CONTROL[control])
                    text = unescape(written)
                    if masked:
                        loss.update(text.encode())
                        loss_chars += len(text)
                    if control == 7:
                        role = text
                    elif control in (1, 3, 5, 8):
                        turns.update(f"{role if control == 8 else roles[control]}\n{text}\n".encode())
                        n += 1
                    before = i
        if at is not nothing:
            yield row()
    return fn


def read_chats(pieces: DataFrame, tokenizer_json: str) -> DataFrame:
    """Per conversation, from its pieces alone: number of turns, digest of the
    turns, characters and digest of the text under the loss mask, and the
    characters of the whole formatted text."""
    return (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
            .select("conv_id", "ids", "loss_mask").mapInArrow(_digest_rows(tokenizer_json), _DIGEST))
