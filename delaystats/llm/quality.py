"""Quality rules and a calibrated n-gram classifier.

Counting rules reject texts that are too short or repeat themselves; the rest
is judged by a logistic regression over hashed word 1- and 2-grams and
character (byte) 3- and 4-grams, trained on labelled rows, calibrated by
Platt scaling on a fold the weights have not seen, and compared with a fixed
threshold.  Features are shares: of the words (characters) of a text, how many
fall on a hashed n-gram, so long and short texts are on one scale.

The fit uses at most SAMPLE labelled texts (smallest salted hash of the id);
scoring is one Arrow pass in which every text is a few numpy gathers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import hash_sample

SAMPLE = 2000           # labelled texts in the fit, at most
BITS = 15               # hashed features per family
THRESHOLD = 0.5         # calibrated probability of good quality to keep
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
STEPS, RATE, DECAY = 300, 0.03, 1e-5

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MUL = np.uint32(0x9E3779B1)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0
    word_chars = len(text) - sum(map(raw.count, (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")))
    n_symbols = int(_SYMBOL[np.frombuffer(raw, np.uint8)].sum())
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    repeat = 0
    if n >= 3:
        ids: dict[bytes, int] = {}
        h = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, n)
        k = np.uint64(len(ids))
        if len(ids) < 2_000_000:        # exact window numbers
            win = (h[:-2] * k + h[1:-1]) * k + h[2:]
            _, inv, cnt = np.unique(win, return_inverse=True, return_counts=True)
            again = cnt[inv] > 1
        else:
            counts: dict[tuple, int] = {}
            wins = list(zip(words, words[1:], words[2:]))
            for x in wins:
                counts[x] = counts.get(x, 0) + 1
            again = np.array([counts[x] > 1 for x in wins])
        hit = np.zeros(n, bool)
        for i in range(3):
            hit[i:n - 2 + i] |= again
        repeat = int(hit.sum())
    return n, word_chars, n_symbols, len(lines) - len(set(lines)), repeat


def features(text: str | None) -> list[np.ndarray]:
    """Hashed ids per family: words, word pairs, byte 3-grams, byte 4-grams."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    h = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    shift = np.uint32(32 - BITS)
    pairs = (h[:-1] * np.uint32(0x85EBCA6B)) ^ h[1:]
    three = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:] if len(b) > 2 else b[:0]
    four = b[:-3] << np.uint32(24) | three[1:] if len(b) > 3 else b[:0]
    return [((x * _MUL) >> shift) + np.uint32(i << BITS) for i, x in enumerate((h, pairs, three, four))]


@dataclass(frozen=True)
class Model:
    """One weight per hashed n-gram, a bias, and the Platt line."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        """Calibrated probability that the text is of good quality."""
        z = self.bias
        for ids in features(text):
            if len(ids):
                z += float(self.weights[ids].mean())
        return float(1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -40, 40))))


def fit_logistic(texts: list[str], labels: list[int]) -> Model:
    """Weights on four fifths, Platt line on the last fifth (of the order given)."""
    size = 4 << BITS
    if not texts or len(set(labels)) < 2:
        even = 20.0 if not labels or labels[0] else -20.0
        return Model(np.zeros(size), even, 1.0, 0.0)
    rows, cols, vals = [], [], []
    for i, t in enumerate(texts):
        for ids in features(t):
            if len(ids):
                u, c = np.unique(ids, return_counts=True)
                rows.append(np.full(len(u), i, np.int32))
                cols.append(u.astype(np.int32))
                vals.append((c / len(ids)).astype(np.float32))
    r, c, x = (np.concatenate(a) for a in (rows, cols, vals))
    y = np.asarray(labels, float)
    n = len(y)
    fold = np.arange(n) % 5 == 4
    if len(set(y[~fold])) < 2 or len(set(y[fold])) < 2:
        fold[:] = False
    train = (~fold).astype(float)
    share = np.where(y == 1, train @ y, train @ (1 - y))
    weight = train / (2 * share)              # both classes count alike
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    use = ~fold[r]
    r0, c0, x0 = r[use], c[use], x[use]
    for step in range(1, STEPS + 1):
        z = b + np.bincount(r0, weights=x0 * w[c0], minlength=n)
        dz = weight * (1 / (1 + np.exp(-z)) - y)
        g = np.append(np.bincount(c0, weights=x0 * dz[r0], minlength=size), dz.sum())
        g[:-1] += DECAY * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        d = RATE * 10 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - d[:-1], b - float(d[-1])
    z = b + np.bincount(r, weights=x * w[c], minlength=n)
    held = fold if fold.any() else ~fold
    s, o = 1.0, 0.0
    for _ in range(50):                       # Newton steps for the Platt line
        q = 1 / (1 + np.exp(-np.clip(s * z[held] + o, -30, 30)))
        k = q * (1 - q) + 1e-6
        a = np.stack([z[held], np.ones(held.sum())])
        grad = a @ (q - y[held]) + 1e-3 * np.array([s - 1, o])
        s, o = np.array([s, o]) - np.linalg.solve((a * k) @ a.T + 1e-3 * np.eye(2), grad) * 0.5
    return Model(w, b, float(s), float(o))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """Model from a bounded sample of the labelled rows.  Null ids, null labels
    and labels without a document are left out; without both classes the model
    gives every text the one class there is (good where there is none)."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    chosen = hash_sample(known.join(texts.select("doc_id").distinct(), "doc_id"), "doc_id", SAMPLE, 3)
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.text or ""))
    return fit_logistic([r.text for r in rows], [r.y for r in rows])


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD, min_words: int = MIN_WORDS,
          max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Counts, rule verdict, quality probability and final verdict of every row.

    Null text is empty: all counts 0, base_failed true, kept false.  Repeated
    rows are judged each; other columns are ignored, whatever their names.
    """
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [base_counts(t) for t in texts]
            n, chars, symbols, dups, rep = (list(x) for x in zip(*counts)) if counts else ([], [], [], [], [])
            failed = [a < min_words or 100 * e > max_repeat_percent * a for a, e in zip(n, rep)]
            score = [model.score(t) for t in texts]
            kept = [not f and s >= threshold for f, s in zip(failed, score)]
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, long), pa.array(chars, long), pa.array(symbols, long),
                 pa.array(dups, long), pa.array(rep, long), pa.array(failed, pa.bool_()),
                 pa.array(score, pa.float64()), pa.array(kept, pa.bool_())],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "quality", "kept"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(fn, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                           "n_repeat_words long, base_failed boolean, quality double, kept boolean")
