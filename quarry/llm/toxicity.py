"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores ``sigmoid(bias + sum of
its distinct words' weights)``; the document is toxic unless every sentence is clean
(noisy-or: ``1 - prod(1 - p)``). Only document labels are known; the gradient
of the noisy-or shares a document's label out among its sentences, so the
fitted sentence scores also say where the offending sentences are.

A word's weight is the sum over features (the word and its leading and
trailing characters), so unseen forms of a known stem score too. Weights are
never negative: clean words don't excuse an insult, and a soft threshold sets
those without evidence to 0. Training
takes a bounded sample of labelled rows (``TRAIN_ROWS``); scoring covers every
whole text in one pass without a shuffle.

Edge cases: a null or empty text has no sentences and scores 0; repeated rows
get equal scores; rows with a null id are scored, never trained on; without
labelled rows of both classes every score is 0; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc_mod, labelled_sample, map_rows, rows_where, texts_of

TRAIN_ROWS = {0: 2500, 1: 1500}  # training documents of each class at most
ROUNDS = 120
LEARNING_RATE = 0.1
L1 = 0.02
MIN_DOCS = 3                     # training documents that a feature must occur in
STRETCH = 200_000                # words of the training sample taken at a time
THRESHOLD = 0.7
MEMO_WORDS = 150_000             # word weights a task remembers, about

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
EDGE = ".,;:!?\"'()[]{}<>|*#%&$-_"


def word_features(word: str) -> tuple[str, ...]:
    """Features of one lower-cased word without edge punctuation."""
    return "w" + word, "3" + word[:3], "4" + word[:4], "5" + word[:5], "e" + word[-4:]


class Weights(dict):
    """Weight of each token met, looked up once and then remembered; when there
    are too many, those met again stay."""

    def __init__(self, theta: dict[str, float]):
        super().__init__()
        self.theta = theta
        self.older: dict[str, float] = {}

    def __missing__(self, token: str) -> float:
        if len(self) >= MEMO_WORDS // 2:
            self.older = dict(self)
            self.clear()
        w = self.older.get(token)
        if w is None:
            word = token.strip(EDGE)
            get = self.theta.get
            w = sum(get(f, 0.0) for f in word_features(word)) if word else 0.0
        self[token] = w
        return w


class Model:
    """Bias and the weights above zero, by feature."""

    def __init__(self, bias: float, theta: dict[str, float]):
        self.bias, self.theta = bias, theta
        self.weights = Weights(theta)

    def __reduce__(self):
        return Model, (self.bias, self.theta)

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of every sentence with a word; code points of
        the text as given."""
        out, weight, bias = [], self.weights.__getitem__, self.bias
        for m in SENTENCE.finditer(text):
            words = m.group().lower().split()
            if words:
                out.append((m.start(), m.end(), bias + sum(map(weight, dict.fromkeys(words)))))
        return out


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def noisy_or(logits: np.ndarray) -> float:
    """1 - prod(1 - sigmoid(z)), from the sum of log(1 - p) = -softplus(z)."""
    return float(-np.expm1(-softplus(logits).sum())) if len(logits) else 0.0


def stretches(sent: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the words of some whole documents at a time (STRETCH words,
    about); ``sent`` is the sentence of each word, ``doc`` the document of each
    sentence, both rising."""
    first = np.searchsorted(sent, np.flatnonzero(np.diff(doc, prepend=-1)))
    ends = np.append(first, len(sent))
    cuts = np.unique(ends[np.searchsorted(ends, np.arange(0, len(sent) + STRETCH, STRETCH).clip(max=len(sent)))])
    return list(zip(cuts.tolist(), cuts[1:].tolist(), strict=False))


def train(rows: list[tuple[str, int]]) -> Model:
    """Full-batch Adam on the noisy-or log loss of the documents."""
    if len({y for _, y in rows}) < 2:
        return Model(-np.inf, {})
    vocab: dict[str, int] = {}
    word, sent, doc = array("i"), array("i"), array("i")
    for d, (text, _) in enumerate(rows):
        for m in SENTENCE.finditer(text):
            tokens = {t: 0 for t in (t.strip(EDGE) for t in m.group().lower().split()) if t}
            if tokens:
                word.extend(vocab.setdefault(t, len(vocab)) for t in tokens)
                sent.extend([len(doc)] * len(tokens))
                doc.append(d)
    word, sent, doc = (np.array(x, np.int32) for x in (word, sent, doc))
    hashes = np.fromiter((hash(f) for w in vocab for f in word_features(w)),
                         np.int64, 5 * len(vocab))        # names only within this call
    names, feats = np.unique(hashes, return_inverse=True)
    feats = feats.reshape(-1, 5).astype(np.int32)
    in_docs = np.zeros(len(names), np.int32)
    parts = stretches(sent, doc)
    for a, b in parts:
        pairs = np.unique(doc[sent[a:b]].astype(np.int64) * len(vocab) + word[a:b])
        for k in range(5):  # a feature of one kind: once per document
            held = np.unique(pairs // len(vocab) * len(names) + feats[pairs % len(vocab), k])
            in_docs += np.bincount(held % len(names), minlength=len(names)).astype(np.int32)
    used = np.flatnonzero(in_docs >= MIN_DOCS)
    place = np.full(len(names), len(used))                # the last slot: rare, weight 0
    place[used] = np.arange(len(used))
    slot = place[feats]
    y = np.array([label for _, label in rows], np.float64)
    n, n_sent, n_slot = len(rows), len(doc), len(used)
    theta, bias = np.zeros(n_slot + 1), -4.0
    m1, v1 = np.zeros(n_slot + 1), np.zeros(n_slot + 1)
    for t in range(1, ROUNDS + 1):
        u = theta[slot].sum(1)
        z = np.empty(n_sent)
        for a, b in parts:
            first, last = sent[a], sent[b - 1] + 1
            z[first:last] = np.bincount(sent[a:b] - first, u[word[a:b]], last - first)
        z += bias
        q = -np.bincount(doc, softplus(z), n)             # log P(clean)
        p_clean = np.exp(q)
        share = np.where(y > 0, -p_clean / np.maximum(1 - p_clean, 1e-9), 1.0)
        dz = share[doc] / (1 + np.exp(-np.clip(z, -500, None))) / n
        du = np.zeros(len(vocab))
        for a, b in parts:
            np.add.at(du, word[a:b].astype(np.intp), dz[sent[a:b]])
        g = np.bincount(slot.ravel(), np.repeat(du, 5), n_slot + 1)
        g[-1] = dz.sum()
        m1, v1 = 0.9 * m1 + 0.1 * g, 0.99 * v1 + 0.01 * g * g
        step = LEARNING_RATE * (m1 / (1 - 0.9 ** t)) / (np.sqrt(v1 / (1 - 0.99 ** t)) + 1e-6)
        bias -= step[-1]
        theta[:-1] = np.maximum(theta[:-1] - step[:-1] - LEARNING_RATE * L1, 0)
    on = theta[slot] > 0
    on[slot == n_slot] = False
    return Model(float(bias), {f: float(theta[slot[i, k]]) for i, w in enumerate(vocab)
                               if on[i].any() for k, f in enumerate(word_features(w)) if on[i, k]})


def fit(docs: DataFrame, labels: DataFrame, fold: Column) -> Model:
    """Train on the bounded sample of the labelled rows that ``fold`` allows."""
    return train(labelled_sample(docs, labels, "toxic", fold, TRAIN_ROWS))


def score(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (``text`` if asked for), then ``score`` and ``offending``
    (start, end and score of the sentences at 0.5 or more)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # features of the bounded sample

    def run(part: pa.RecordBatch) -> dict:
        net, scores, where = shared.value, [], []
        for text in texts_of(part):
            found = net.sentences(text)
            scores.append(noisy_or(np.array([z for _, _, z in found])))
            where.append([{"start": s, "end": e, "score": float(1 / (1 + np.exp(-z)))}
                          for s, e, z in found if z >= 0])
        return {"score": scores, "offending": where}

    return map_rows(docs, run, "score double, "
                    "offending array<struct<start: long, end: long, score: double>>",
                    keep_text=keep_text)


def op2_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    fold = crc_mod(F.col("doc_id"), 3)
    model = fit(docs, labels, fold != 1)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: the documents whose score stays below THRESHOLD, with
    the columns of ``docs``. A text is rejected whole; all rows with a clean
    text are kept."""
    model = fit(docs, labels, crc_mod(F.col("doc_id"), 3) != 1)
    return rows_where(docs, lambda d: score(d, model, keep_text=True), ["score", "offending"],
                      F.col("score") < THRESHOLD)
