"""Language-model scoring by masked pseudo-likelihood.

A network in numpy predicts every word from the two words on either side of
it. The neighbours' embeddings, scaled by a vector per place, are summed and
squashed by tanh. From these hidden units a softmax gives the word's class (a
band of frequency), and binary decisions down a tree of the class's words,
each a logistic unit on the same hidden units, give the word: its probability
within the class depends on the words beside it. Probabilities over all ids
sum to one. The sum of the conditional log-probabilities of all words of a
document is its score.

Words are counted over all documents. The 2 * sqrt(words of the corpus) most
frequent (``own_words``, at least SMALLEST) have an id of their own; a quarter as
many ids are shared by the others, by checksum, and a word's probability is
its id's, divided by the number of words that share it. The model grows with the
root of the corpus: on 1.5e13 words (about 100 TB) 7.7 million words, 1.2 GB
of weights, which the driver, the broadcast and every task hold.

Training passes over all documents too: every task runs AdaGrad on the words
of its partition from the common weights, and each row of weights is averaged
over the tasks by how often it was met in them. In round r the documents with
hash % ROUNDS = r train, so the rounds cover each document once. The weights
therefore depend a little on how the table is partitioned.

Edge cases: a null or empty text has no words and scores 0 (mean null);
repeated rows get equal scores; null ids are kept; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, discard, map_rows, slices, stored

SMALLEST = 4096     # words with an id of their own on small corpora
CLASSES = 32
DIM = 16            # hidden units; the last one is constant 1, its weights are biases
SIDE = 2            # words on either side
ROUNDS = 2
BATCH = 32768
LEARNING_RATE = 0.15
DAMPING = 3.0       # words' worth of gradient that AdaGrad's sums start with
COUNTED = 400_000   # distinct words that a task counts before it hands them on
BLOCK = 1024        # rows of weights that are summed together
SPREAD = 32         # tasks that sum a block's rows before one adds their sums

#: Rows of the weights: a scale per place, the bias, classes; then the
#: embeddings and the tree nodes (``Net``).
PLACES = [o for o in range(-SIDE, SIDE + 1) if o]
FIRST = len(PLACES) + 1 + CLASSES


def own_words(total: int) -> int:
    """Words with an id of their own in a corpus of ``total`` words."""
    return max(SMALLEST, 2 * math.isqrt(total))


class Vocabulary:
    """Ids of words; a word without its own gets the one of its bucket. By id:
    ``classes``; ``leaf``, the word's place in the tree of its class (a heap: node
    i has children 2i and 2i+1, the root is 1); ``rise``, minus its depth; ``base``,
    the row of that tree among the nodes; ``place``, the rank by the three;
    ``log_kinds``, the log of the number of words with that id."""

    def __init__(self, words: list[str], mass: np.ndarray, kinds: np.ndarray):
        self.words, self.mass, self.kinds = words, mass, kinds
        self.own = pa.array(words, pa.string())
        self.buckets = len(mass) - len(words)
        self.pad = n = len(mass)  # id beyond the ends of a document
        order = np.argsort(-mass, kind="stable")
        before = np.cumsum(mass[order]) - mass[order]
        of = np.minimum(before * CLASSES // mass.sum(), CLASSES - 1).astype(np.int64)
        size = np.bincount(of, minlength=CLASSES)
        start = np.cumsum(size) - size
        self.classes, self.leaf, self.base = (np.empty(n, np.int64) for _ in range(3))
        self.classes[order], self.base[order] = of, start[of]
        self.leaf[order] = size[of] + np.arange(n) - start[of]
        self.rise = -np.floor(np.log2(self.leaf)).astype(np.int64)
        self.place = np.empty(n, np.min_scalar_type(n))
        self.place[np.lexsort((self.leaf, self.base, self.rise))] = np.arange(n)
        self.log_kinds = np.log(kinds)

    def __reduce__(self):
        return Vocabulary, (self.words, self.mass, self.kinds)

    def ids(self, words: pa.Array) -> np.ndarray:
        found = pc.index_in(words, value_set=self.own)
        out = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        other = np.flatnonzero(out < 0)
        if len(other):
            coded = words.take(pa.array(other)).dictionary_encode()
            of = [bucket(w, len(self.words), self.buckets)
                  for w in coded.dictionary.to_numpy(zero_copy_only=False)]
            out[other] = np.array(of, np.int64)[coded.indices.to_numpy()]
        return out


def bucket(word: str, words: int, buckets: int) -> int:
    return words + zlib.crc32(word.encode()) % buckets


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts (null: none), words per text."""
    parts = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words, of = parts.flatten(), pc.list_parent_indices(parts)
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), np.bincount(of.filter(full).to_numpy(), minlength=len(texts))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all lower-cased words of all texts."""
    schema = arrow_schema("word string, n long")

    def run(batches):
        counts: Counter[str] = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                schema=schema)
            counts.clear()
            return batch

        for part in slices(batches):
            words, _ = words_of(part.column("text"))
            groups = pc.value_counts(words)
            counts.update(dict(zip(groups.field(0).to_numpy(zero_copy_only=False).tolist(),
                                   groups.field(1).to_numpy().tolist(), strict=True)))
            if len(counts) > COUNTED:
                yield out()
        yield out()

    return (docs.select("text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary(docs: DataFrame) -> Vocabulary:
    """The most frequent words (ties by the word) and the counts of the other
    words by bucket."""
    counts = stored(word_counts(docs), "lm-words")
    own = own_words(counts.agg(F.sum("n")).first()[0] or 0)
    top = stored(counts.orderBy(F.desc("n"), "word").limit(own), "lm-top")
    rows = top.orderBy(F.desc("n"), "word").collect()  # own_words() rows
    buckets = own // 4
    # checksum of UTF-8 as in bucket()
    rest = (counts.join(top.select("word"), "word", "left_anti")
            .groupBy((F.crc32(F.col("word").cast("binary")) % buckets).cast("int").alias("b"))
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect())
    discard(counts, top)
    mass, kinds = np.full(len(rows) + buckets, 0.5), np.ones(len(rows) + buckets)
    mass[:len(rows)] = [r.n for r in rows]
    for r in rest:
        mass[len(rows) + r.b], kinds[len(rows) + r.b] = r.n, r.k
    return Vocabulary([r.word for r in rows], mass, kinds)


# --- network ---------------------------------------------------------------

class Net:
    """Views of the weights, a matrix of DIM columns."""

    def __init__(self, rows: np.ndarray, pad: int):
        at = len(PLACES)
        self.scale, self.bias, self.out = rows[:at], rows[at], rows[at + 1:FIRST]
        self.emb, self.nodes = rows[FIRST:FIRST + pad + 1], rows[FIRST + pad + 1:]


def first_weights(vocab: Vocabulary) -> np.ndarray:
    """Small embeddings; classes and words at their shares in the corpus."""
    rng = np.random.default_rng(1)
    rows = np.zeros((FIRST + 2 * vocab.pad + 1, DIM), np.float32)
    net = Net(rows, vocab.pad)
    net.scale[:] = 1
    net.emb[:] = rng.normal(0, 0.1, net.emb.shape)
    net.out[:, -1] = np.log(np.bincount(vocab.classes, vocab.mass, CLASSES) + 1e-9)
    size = np.bincount(vocab.classes, minlength=CLASSES)
    for c in np.flatnonzero(size > 1).tolist():
        m, ids = int(size[c]), np.flatnonzero(vocab.classes == c)
        mass = np.zeros(2 * m)
        mass[vocab.leaf[ids]] = vocab.mass[ids]
        for level in reversed(range(m.bit_length())):
            i = np.arange(2 ** level, min(2 ** (level + 1), m))
            mass[i] = mass[2 * i] + mass[2 * i + 1]
        i = np.arange(1, m)
        net.nodes[vocab.base[ids[0]] + i, -1] = np.log(mass[2 * i + 1] / mass[2 * i])
    return rows


def windows(vocab: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids with PADs between texts and at both ends, words per text."""
    words, sizes = words_of(texts)
    flat = np.full(len(words) + SIDE * (len(texts) + 1), vocab.pad, np.int64)
    flat[np.arange(len(words)) + SIDE * (1 + np.repeat(np.arange(len(texts)), sizes))] = (
        vocab.ids(words))
    return flat, sizes


def chunks(flat: np.ndarray):
    """Stretches of about BATCH ids, each with SIDE ids more at both ends."""
    for k in range(SIDE, len(flat) - SIDE, BATCH):
        yield flat[k - SIDE:min(k + BATCH, len(flat) - SIDE) + SIDE]


def hidden(net: Net, ids: np.ndarray, pad: int):
    """(embeddings of the stretch, places of its words, their hidden units)."""
    x, n = net.emb[ids], len(ids) - 2 * SIDE
    total = np.broadcast_to(net.bias, (n, DIM)).copy()
    for k, o in enumerate(PLACES):
        total += x[SIDE + o:SIDE + o + n] * net.scale[k]
    at = np.flatnonzero(ids[SIDE:SIDE + n] != pad)
    h = np.tanh(total[at])
    h[:, -1] = 1
    return x, at, h


def by_leaf(vocab: Vocabulary, own: np.ndarray) -> np.ndarray:
    """Order of the words ``own``: deepest first, then by their leaves."""
    return np.argsort(vocab.place[own], kind="stable")


def levels(vocab: Vocabulary, own: np.ndarray):
    """The way from the words, in order of ``by_leaf``, to the roots of their
    trees, level by level: (rows of the nodes, whether the right child is
    taken) of the words that are that deep, the first ones. Words below one
    node stand together, but for their depth."""
    at, base, rise = vocab.leaf[own], vocab.base[own], vocab.rise[own]
    for k in range(-int(rise[0]) if len(own) else 0):
        n = int(np.searchsorted(rise, -k, side="left"))
        right = (at[:n] & 1).astype(np.float32)
        at = at[:n] >> 1
        yield base[:n] + at, right


def class_shares(net: Net, h: np.ndarray) -> np.ndarray:
    z = h @ net.out.T
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def decisions(net: Net, h: np.ndarray, node: np.ndarray):
    """(weights of the nodes, log odds of their right children)."""
    w = net.nodes.take(node, axis=0)
    return w, np.einsum("ij,ij->i", h[:len(node)], w)


def log_probabilities(net: Net, vocab: Vocabulary, h: np.ndarray, own: np.ndarray) -> np.ndarray:
    """log P(word | the words beside it) of the words ``own``."""
    order = by_leaf(vocab, own)
    own, h = own[order], h[order]
    share = class_shares(net, h)[np.arange(len(own)), vocab.classes[own]]
    logp = np.log(share.astype(np.float64) + 1e-30) - vocab.log_kinds[own]
    for node, right in levels(vocab, own):
        _, z = decisions(net, h, node)
        z *= 1 - 2 * right  # log odds against the child taken
        logp[:len(z)] -= np.maximum(z, 0) + np.log(1 + np.exp(-np.abs(z)))
    out = np.empty_like(logp)
    out[order] = logp
    return out


def summed_rows(rows: np.ndarray, values: np.ndarray, met: np.ndarray):
    """Values and counts of neighbours with one row number added up."""
    start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    pairs = values.view(np.result_type(values, np.complex64))  # two columns at a time
    return (rows[start], np.add.reduceat(pairs, start, axis=0).view(values.dtype),
            np.add.reduceat(met, start))


def sorted_rows(rows: np.ndarray, values: np.ndarray, met: np.ndarray, most: int):
    order = np.argsort(rows.astype(np.min_scalar_type(most)), kind="stable")
    return summed_rows(rows[order], values.take(order, axis=0), met[order])


class Learner:
    """Weights that a task trains, AdaGrad's sums, and how often rows were met."""

    def __init__(self, rows: np.ndarray, vocab: Vocabulary):
        self.rows, self.vocab = rows, vocab
        self.net = Net(rows, vocab.pad)
        self.sums = np.full_like(rows, (DAMPING / BATCH) ** 2)
        self.met = np.zeros(len(rows))

    def gradient(self, ids: np.ndarray):
        """(words of the stretch; rows of weights met, their gradients, how
        often they were met)."""
        net, vocab = self.net, self.vocab
        x, at, h = hidden(net, ids, vocab.pad)
        n = len(at)
        order = by_leaf(vocab, ids[SIDE + at])
        at, h = at[order], h[order]
        own = ids[SIDE + at]
        d = class_shares(net, h)
        d[np.arange(n), vocab.classes[own]] -= 1
        back, nodes = d @ net.out, []
        for node, right in levels(vocab, own):
            w, z = decisions(net, h, node)
            e = (1 / (1 + np.exp(-z)) - right)[:, None]
            w *= e
            back[:len(e)] += w
            nodes.append(summed_rows(node, h[:len(e)] * e, np.ones(len(e))))
        back *= 1 - h * h  # 0 for the constant unit
        full, spread = np.zeros((len(ids) - 2 * SIDE, DIM), back.dtype), np.zeros_like(x)
        full[at] = back
        dense = np.empty((FIRST, DIM), back.dtype)
        for k, o in enumerate(PLACES):
            near = slice(SIDE + o, SIDE + o + len(full))
            dense[k] = np.einsum("ij,ij->j", full, x[near])
            spread[near] += full * net.scale[k]
        dense[len(PLACES)], dense[len(PLACES) + 1:] = back.sum(0), d.T @ h
        parts = [(np.arange(FIRST), dense, np.full(FIRST, float(n)))]
        some, g, met = sorted_rows(ids, spread, np.ones(len(ids)), vocab.pad)
        parts.append((FIRST + some, g, met))
        if nodes:
            some, g, met = sorted_rows(*map(np.concatenate, zip(*nodes, strict=True)), vocab.pad)
            parts.append((FIRST + vocab.pad + 1 + some, g, met))
        return n, *map(np.concatenate, zip(*parts, strict=True))

    def learn(self, ids: np.ndarray) -> None:
        """One AdaGrad step on the words of a stretch; only rows met change."""
        n, some, g, met = self.gradient(ids)
        if not n:
            return
        g /= n
        self.met[some] += met
        self.sums[some] += g * g
        g /= np.sqrt(self.sums[some])
        g *= LEARNING_RATE
        self.rows[some] -= g


WEIGHTS = "block int, salt int, met binary, change binary"


def block_rows(schema: pa.Schema, block: int, salt: int, met: np.ndarray, change: np.ndarray):
    return pa.RecordBatch.from_pylist([{"block": block, "salt": salt, "met": met.tobytes(),
                                        "change": change.tobytes()}], schema=schema)


def summed(parts: DataFrame) -> DataFrame:
    """Counts and weighted changes of each block added up, in two steps."""
    schema = arrow_schema(WEIGHTS)

    def run(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                met, change = np.frombuffer(r["met"]), np.frombuffer(r["change"])
                if r["block"] in total:
                    total[r["block"]][0] += met
                    total[r["block"]][1] += change
                else:
                    total[r["block"]] = [met.copy(), change.copy()]
        for block, (met, change) in total.items():
            yield block_rows(schema, block, 0, met, change)

    once = parts.repartition("block", "salt").mapInArrow(run, WEIGHTS)
    return once.repartition("block").mapInArrow(run, WEIGHTS)


def one_round(docs: DataFrame, vocab, rows: np.ndarray, number: int) -> np.ndarray:
    """Weights after the documents of round ``number``: each task trains on
    its own; a row's change is averaged by how often it was met."""
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    schema = arrow_schema(WEIGHTS)

    def run(batches):
        learner = None
        for part in slices(batches):
            learner = learner or Learner(shared.value.copy(), vocab.value)
            order = np.random.default_rng(part.num_rows).permutation(part.num_rows)
            flat, _ = windows(vocab.value, part.column("text").take(pa.array(order)))
            for ids in chunks(flat):
                learner.learn(ids)
        if learner is None:
            return
        salt = TaskContext.get().partitionId() % SPREAD
        for k in range(0, len(learner.rows), BLOCK):
            met = learner.met[k:k + BLOCK]
            if met.any():
                change = learner.rows[k:k + BLOCK].astype(np.float64) - shared.value[k:k + BLOCK]
                yield block_rows(schema, k // BLOCK, salt, met, change * met[:, None])

    mine = docs.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == number).select("text")
    out = rows.copy()
    for r in summed(mine.mapInArrow(run, WEIGHTS)).toLocalIterator():  # as large as the weights
        met, k = np.frombuffer(r.met), r.block * BLOCK
        out[k:k + len(met)] += (np.frombuffer(r.change).reshape(-1, DIM)
                                / np.maximum(met, 1)[:, None]).astype(np.float32)
    shared.destroy()
    return out


def fit(docs: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    words = vocabulary(docs)
    rows = first_weights(words)
    shared = docs.sparkSession.sparkContext.broadcast(words)  # own_words() words
    for number in range(ROUNDS):
        rows = one_round(docs, shared, rows, number)
    shared.destroy()
    return words, rows


def text_scores(words: Vocabulary, rows: np.ndarray, texts: pa.Array):
    """(words, sum of log-probabilities) of every text."""
    net = Net(rows, words.pad)
    flat, sizes = windows(words, texts)
    logp = [np.empty(0)]
    for ids in chunks(flat):
        _, at, h = hidden(net, ids, words.pad)
        logp.append(log_probabilities(net, words, h, ids[SIDE + at]))
    text = np.repeat(np.arange(len(sizes)), sizes)
    return sizes, np.bincount(text, np.concatenate(logp), len(sizes))


def score(docs: DataFrame, model: tuple[Vocabulary, np.ndarray]) -> DataFrame:
    """All columns of ``docs`` but ``text``, then ``n_words``, ``pseudo_log_likelihood``
    and ``mean_log_probability`` (null without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary and weights

    def run(part: pa.RecordBatch) -> dict:
        sizes, sums = text_scores(*shared.value, part.column("text"))
        return {"n_words": sizes, "pseudo_log_likelihood": sums,
                "mean_log_probability": [s / n if n else None for s, n in
                                         zip(sums.tolist(), sizes.tolist(), strict=True)]}

    return map_rows(docs, run, "n_words long, pseudo_log_likelihood double, "
                    "mean_log_probability double")


def op1_lm_score(docs: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"), fit(docs))
