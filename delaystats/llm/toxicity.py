"""Toxicity by non-negative positive-unlabelled learning.

The learner sees confirmed toxic texts (P) and unlabelled texts (U) of the
same table; no text is ever given as clean.  With the class prior pi, the
risk of a linear scorer f under the logistic loss l is

    pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)])

whose second part estimates the loss on clean texts; where a step drives that
estimate below zero the step goes back up on it instead (the non-negative
correction), which keeps f from memorising P.  Features are the distinct
lower-cased words of a text that P texts have clearly more often than U texts
(a z-test on the shares; of words that are no more frequent in P, f can learn
nothing but P itself).

The fit uses bounded samples (POSITIVES, UNLABELLED: texts with the smallest
salted hash of their id); the prior is counted over all labels that may be
learnt from.  Scoring is one Arrow pass over every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import hash_sample, held_out, lean, written

POSITIVES = 2500        # confirmed toxic texts in the fit, at most
UNLABELLED = 5000       # unlabelled texts in the fit, at most
MIN_POSITIVES = 5       # a word counts if so many P texts have it
MIN_SHARE = 0.01        # ... and this share of them (a family of near copies is no evidence)
MIN_Z = 5.0             # ... and so many standard errors more often than U texts
VOCABULARY = 50_000     # words in the model, at most (most frequent in P first)
STEPS, RATE, DECAY = 600, 0.05, 1e-5

STEMS = (5, 7)          # letters of a word's beginning
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """Distinct lower-cased letter words of a text (null: none), and the
    beginnings of the longer ones (``stem*``), which inflected words share."""
    words = set(_WORD.findall((text or "").lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


@dataclass(frozen=True)
class Model:
    """Word weights and bias; score = sigmoid(bias + sum of the words' weights)."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        w = self.weights
        z = self.bias + sum(w[x] for x in sorted(w.keys() & words_of(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def least_positives(n: int) -> int:
    """So many of ``n`` P texts must have a word that counts."""
    return max(min(MIN_POSITIVES, max(n // 4, 1)), int(MIN_SHARE * n))


def fit_nnpu(positive, unlabelled, prior: float) -> Model:
    """Minimise the non-negative risk by full-batch Adam in numpy.  The texts
    are lists of distinct words (Python or Arrow lists)."""
    kind = pa.list_(pa.string())
    p_docs, u_docs = (x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind) for x in (positive, unlabelled))
    if not len(u_docs):
        u_docs = p_docs
    coded = pc.dictionary_encode(pa.concat_arrays([p_docs.flatten(), u_docs.flatten()]))
    codes = np.asarray(coded.indices).astype(np.int64)
    words, size = coded.dictionary, len(coded.dictionary)
    cut = len(p_docs.flatten())
    n_p, n_u = max(len(p_docs), 1), max(len(u_docs), 1)
    seen, usual = np.bincount(codes[:cut], minlength=size), np.bincount(codes[cut:], minlength=size)
    share = (seen + usual) / (n_p + n_u)
    z = (seen / n_p - usual / n_u) / np.maximum(np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u)), 1e-9)
    picked = np.flatnonzero((seen >= least_positives(len(p_docs))) & (z >= MIN_Z))
    names = words.take(pa.array(picked)).to_pylist()
    order = sorted(range(len(picked)), key=lambda i: (-seen[picked[i]], names[i]))[:VOCABULARY]
    vocab = [names[i] for i in order]
    if not vocab:
        return Model({}, -40.0 if prior <= 0 else float(np.log(prior / max(1 - prior, 1e-9))))
    prior = min(max(prior, 1e-4), 0.9)
    column = np.full(size, -1)
    column[picked[order]] = np.arange(len(vocab))

    def sparse(docs, part):
        row = np.repeat(np.arange(len(docs)), np.diff(np.asarray(docs.offsets)))
        col = column[part]
        return row[col >= 0], col[col >= 0], len(docs)

    p, u = sparse(p_docs, codes[:cut]), sparse(u_docs, codes[cut:])
    w, b = np.zeros(len(vocab)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(vocab) + 1), np.zeros(len(vocab) + 1)

    def forward(x):
        return b + np.bincount(x[0], weights=w[x[1]], minlength=x[2])

    def grad(x, dz):
        dz = dz / x[2]
        return np.append(np.bincount(x[1], weights=dz[x[0]], minlength=len(w)), dz.sum())

    for step in range(1, STEPS + 1):
        fp, fu = forward(p), forward(u)
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        clean = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_clean = grad(u, su) - prior * grad(p, sp)
        g = prior * grad(p, sp - 1) + g_clean if clean >= 0 else -g_clean
        g[:-1] += DECAY * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        d = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - d[:-1], b - float(d[-1])
    return Model({x: float(y) for x, y in zip(vocab, w)}, b)


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [sorted(words_of(t)) for t in batch.column(0).to_pylist()]
        yield pa.record_batch({"words": pa.array(lists, pa.list_(pa.string()))})


def _words_among(names: set[str]):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[w for w in words if w in names] for words in batch.column(0).to_pylist()]
            yield pa.record_batch({"words": pa.array(lists, pa.list_(pa.string()))})
    return fn


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Model from the labelled and unlabelled rows that may be learnt from.

    Ids without a label row, null ids and null labels are unlabelled text only.
    An empty table or one without confirmed toxic texts gives a model without
    words whose score is the prior (0 where there are no labels).
    """
    ids = docs.select(F.col(id_col).alias("doc_id")).where("doc_id is not null").where(~held_out(F.col("doc_id")))
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y"))
             .where("doc_id is not null and y is not null").where(~held_out(F.col("doc_id"))))
    prior = known.agg(F.avg(F.col("y").cast("double"))).first()[0] or 0.0
    toxic = known.where("y = 1").select("doc_id").distinct()
    chosen_p = hash_sample(ids.join(toxic, "doc_id", "left_semi").distinct(), "doc_id", POSITIVES, 1)
    chosen_u = hash_sample(ids.distinct(), "doc_id", UNLABELLED, 2)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def lists(chosen):      # at most POSITIVES or UNLABELLED ids, so the broadcast is bounded
        rows = texts.join(F.broadcast(chosen), "doc_id", "left_semi").select("text")
        return written(rows.mapInArrow(lean(_word_lists), "words array<string>"), "words")

    p_lists, u_lists = lists(chosen_p), lists(chosen_u)
    common = (p_lists.select(F.explode("words").alias("word")).groupBy("word").count()
              .where(F.col("count") >= least_positives(p_lists.count())).select("word").toArrow())
    names = set(common.column("word").to_pylist())

    def of_use(rows):       # the driver gets the words only that can count
        got = rows.mapInArrow(_words_among(names), "words array<string>").toArrow().column("words")
        return pa.concat_arrays(got.chunks) if got.num_chunks else pa.array([], pa.list_(pa.string()))

    return fit_nnpu(of_use(p_lists), of_use(u_lists), float(prior))


def _scores(model: Model):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [model.score(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())],
                                             names=[*batch.schema.names[:-1], "score"])
    return fn


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and toxicity score (0 to 1) of every row, repeated rows included;
    null and empty texts get the score of a text without words."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns kept, that score below ``threshold``."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(t) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(lean(fn), schema)
