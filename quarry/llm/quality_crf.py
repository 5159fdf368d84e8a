"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's unary score is linear in binned features
of the line itself and of the lines before and after it; a transition matrix
ties neighbouring lines together. Forward-backward gives each line's marginal,
and the length-weighted mean of the marginals is the document's quality.

Training takes a bounded sample of labelled documents (``TRAIN_ROWS``); lines
inherit the label of their document, and the conditional log-likelihood is
climbed with Adam. Scoring covers every whole text in one pass, no shuffle.

Edge cases: a null or empty text is one empty line and is scored like any
other; repeated rows get equal scores; rows with a null id are scored, never
trained on; without labelled rows of both classes every score is 0.5; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc_mod, labelled_sample, map_rows, rows_where, texts_of

TRAIN_ROWS = {0: 3000, 1: 5000}
ROUNDS = 200
LEARNING_RATE = 0.15
L2 = 1e-4
THRESHOLD = 0.3
BINS = 8       # values of one line feature
N_FEATURES = 9
WIDTH = N_FEATURES * BINS * 3  # previous, own, next line
TEXTS = 250       # training documents made into columns at a time
STRETCH = 16_384  # lines whose weights are looked up at a time

#: Byte classes counted for each line.
SYMBOL, UPPER, LETTER, DIGIT, BLANK, STOP, SHOUT, BAR = range(8)


def byte_classes() -> np.ndarray:
    """(8, 256) table: 1 where a byte belongs to the class."""
    t = np.zeros((8, 256), np.uint8)
    for kind, chars in ((SYMBOL, b"#$%&*<>{}[]=_~^\\"), (DIGIT, b"0123456789"),
                        (BLANK, b" \t\x0b\x0c\r"), (STOP, b".?"), (SHOUT, b"!"), (BAR, b"|")):
        t[kind, list(chars)] = 1
    t[UPPER, 65:91] = 1
    t[LETTER, 65:91] = t[LETTER, 97:123] = t[LETTER, 128:256] = 1
    return t


CLASSES = byte_classes()


def binned(share: np.ndarray) -> np.ndarray:
    """0 for none, then bins of doubling width up to 1 and above."""
    return np.where(share <= 0, 0, np.clip(np.ceil(np.log2(np.maximum(share, 1e-9)) + 6),
                                           1, BINS - 1)).astype(np.int64)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binned features of all lines of ``texts``: (lines, N_FEATURES) bins,
    the document of each line, and the line's weight (its bytes plus one)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lines = [line for t in raw for line in t.split(b"\n")]
    doc = np.repeat(np.arange(len(raw)), [t.count(b"\n") + 1 for t in raw])
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    size = np.array([len(x) for x in lines], np.int64) + 1
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    count = [np.add.reduceat(CLASSES[k][buf], start, dtype=np.int64) for k in range(len(CLASSES))]
    words = count[BLANK] + 1.0
    letters = np.maximum(count[LETTER], 1)
    twice = np.empty(len(lines))  # share of words equal to the word before
    copies = np.empty(len(lines), np.int64)
    seen: dict[bytes, int] = {}
    last = -1
    for i, line in enumerate(lines):
        if doc[i] != last:
            seen, last = {}, doc[i]
        copies[i] = seen[line] = seen.get(line, -1) + 1
        w = line.split()
        twice[i] = sum(map(bytes.__eq__, w[1:], w)) / len(w) if w else 0.0
    bins = np.stack([
        binned(count[SYMBOL] / words), binned(count[UPPER] / letters / 1.0),
        binned(count[DIGIT] / size), binned(count[SHOUT] / words), binned(count[BAR] / words),
        binned(count[STOP] / words), binned(twice), np.minimum(copies, BINS - 1),
        np.clip(np.log2(words), 0, BINS - 1).astype(np.int64)], axis=1)
    return bins, doc, size.astype(np.float64)


def design(bins: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Feature columns of each line: its own bins and its neighbours' (-1
    where the document has no such line)."""
    own = bins + np.arange(N_FEATURES) * BINS
    block = N_FEATURES * BINS
    before, after = np.full_like(own, -1), np.full_like(own, -1)
    same = doc[1:] == doc[:-1]
    before[1:][same] = own[:-1][same] + block
    after[:-1][same] = own[1:][same] + 2 * block
    return np.concatenate([own, before, after], axis=1)


def chains(doc: np.ndarray) -> list[np.ndarray]:
    """Lines of all documents by position: k-th entry has the indices of the
    k-th lines of the documents that are that long (longest first)."""
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    length = np.diff(np.r_[first, len(doc)])
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    counts = np.searchsorted(-length, -np.arange(1, length.max() + 1), side="right")
    return [first[:n] + k for k, n in enumerate(counts)]


def forward_backward(unary: np.ndarray, trans: np.ndarray, steps: list[np.ndarray]):
    """Log alpha and beta of every line for all chains at once; unary is
    (lines, 2), trans[i, j] scores j after i."""
    alpha, beta = unary.copy(), np.zeros_like(unary)
    for k in range(1, len(steps)):
        now, old = steps[k], steps[k - 1][:len(steps[k])]
        alpha[now] += np.logaddexp(alpha[old, 0:1] + trans[0], alpha[old, 1:2] + trans[1])
    for k in range(len(steps) - 2, -1, -1):
        nxt, now = steps[k + 1], steps[k][:len(steps[k + 1])]
        ahead = unary[nxt] + beta[nxt]
        beta[now] = np.logaddexp(trans[:, 0] + ahead[:, 0:1], trans[:, 1] + ahead[:, 1:2])
    return alpha, beta


def marginals(alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """P(line is good)."""
    s = alpha + beta
    return 1 / (1 + np.exp(np.clip(s[:, 0] - s[:, 1], -700, 700)))


def unaries(cols: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of label good per line (label bad scores 0)."""
    padded = np.append(weights, 0.0)  # column -1
    good = np.empty(len(cols))
    for at in range(0, len(cols), STRETCH):
        good[at:at + STRETCH] = padded[cols[at:at + STRETCH]].sum(1)
    return np.stack([np.zeros_like(good), good], axis=1)


def training_columns(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature columns and document of every line, made from some texts at a
    time and kept in 16 bits: the driver holds little beside the sample."""
    cols, doc = [], []
    for at in range(0, len(texts), TEXTS):
        bins, own, _ = line_features(texts[at:at + TEXTS])
        cols.append(design(bins, own).astype(np.int16))
        doc.append(own + at)
    return np.concatenate(cols), np.concatenate(doc)


def gradient(cols: np.ndarray, err: np.ndarray) -> np.ndarray:
    """Sum of ``err`` over the lines of every feature column. Every place of
    ``cols`` has its own BINS columns (or -1)."""
    g = np.empty(WIDTH)
    for k in range(cols.shape[1]):
        own = np.where(cols[:, k] < 0, BINS, cols[:, k] - k * BINS)
        g[k * BINS:(k + 1) * BINS] = np.bincount(own, err, BINS + 1)[:BINS]
    return g


def train(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(unary weights with a bias at the end, transition matrix)."""
    if len({y for _, y in rows}) < 2:
        return np.zeros(WIDTH + 1), np.zeros((2, 2))
    rows = sorted(rows, key=lambda r: (len(r[0]), r[0], r[1]))
    cols, doc = training_columns([t for t, _ in rows])
    steps = chains(doc)
    y_doc = np.array([y for _, y in rows], np.float64)
    y = y_doc[doc]
    lines = np.bincount(doc)
    own = 1.0 / lines[doc]         # every document counts once
    same = np.flatnonzero(doc[1:] == doc[:-1])
    w, trans = np.zeros(WIDTH + 1), np.zeros((2, 2))
    m, v = np.zeros(WIDTH + 5), np.zeros(WIDTH + 5)
    n = len(rows)
    for t in range(1, ROUNDS + 1):
        u = unaries(cols, w[:-1])
        u[:, 1] += w[-1]
        alpha, beta = forward_backward(u, trans, steps)
        good = marginals(alpha, beta)
        err = (y - good) * own
        g = gradient(cols, err)
        pair = alpha[same][:, :, None] + trans + (u + beta)[same + 1][:, None, :]
        pair = np.exp(pair - np.logaddexp.reduce(pair.reshape(len(same), 4), axis=1)[:, None, None])
        hit = np.zeros_like(pair)
        hit[np.arange(len(same)), y[same].astype(int), y[same + 1].astype(int)] = 1
        gt = ((hit - pair) * own[same][:, None, None]).sum(0)
        grad = np.concatenate([g, [err.sum()], gt.ravel()]) / n
        grad -= L2 * np.concatenate([w[:-1], [0], trans.ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = LEARNING_RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        w, trans = w + step[:WIDTH + 1], trans + step[WIDTH + 1:].reshape(2, 2)
    return w, trans


def line_marginals(texts: list[str], model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good), document and weight of every line of ``texts``."""
    w, trans = model
    bins, doc, size = line_features(texts)
    u = unaries(design(bins, doc), w[:-1])
    u[:, 1] += w[-1]
    alpha, beta = forward_backward(u, trans, chains(doc))
    return marginals(alpha, beta), doc, size


def quality(texts: list[str], model) -> np.ndarray:
    """Length-weighted mean of the line marginals of each text."""
    good, doc, size = line_marginals(texts, model)
    n = len(texts)
    return np.bincount(doc, good * size, n) / np.bincount(doc, size, n)


def fit(docs: DataFrame, labels: DataFrame, fold: Column):
    return train(labelled_sample(docs, labels, "quality", fold, TRAIN_ROWS))


def score(docs: DataFrame, model, keep_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (``text`` if asked for), then ``score`` and ``bad_lines``
    (numbers from 0 of the lines that are rather bad)."""

    def run(part: pa.RecordBatch) -> dict:
        texts = texts_of(part)
        good, doc, size = line_marginals(texts, model)
        n = len(texts)
        first = np.searchsorted(doc, np.arange(n))
        bad = [[] for _ in range(n)]
        for i in np.flatnonzero(good < 0.5).tolist():
            bad[doc[i]].append(i - int(first[doc[i]]))
        total = np.bincount(doc, good * size, n) / np.bincount(doc, size, n)
        return {"score": np.clip(total, 0, 1), "bad_lines": bad}

    return map_rows(docs, run, "score double, bad_lines array<int>", keep_text=keep_text)


def op8_quality_crf(docs: DataFrame, labels: DataFrame) -> DataFrame:
    fold = crc_mod(F.col("doc_id"), 5)
    model = fit(docs, labels, fold != 0)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "bad_lines")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: the documents that score THRESHOLD or more, with the
    columns of ``docs``."""
    model = fit(docs, labels, crc_mod(F.col("doc_id"), 5) != 0)
    return rows_where(docs, lambda d: score(d, model, keep_text=True), ["score", "bad_lines"],
                      F.col("score") >= THRESHOLD)
