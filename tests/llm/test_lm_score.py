import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import lm_score as L
from tests.llm.fixtures import ODD, SCHEMA, frame


def cycle(seed, n):
    """Text in which a word follows from its neighbours."""
    rng = random.Random(seed)
    words = ["red", "green", "blue", "cyan", "pink", "gold"]
    at = rng.randrange(6)
    return " ".join(words[(at + i) % 6] for i in range(n))


def small_vocabulary(n=300):
    words = [f"w{i}" for i in range(n)]
    mass = np.r_[2000.0 / (1 + np.arange(n)), np.full(n // 4, 3.0)]
    return L.Vocabulary(words, mass, np.r_[np.ones(n), np.arange(n // 4) % 5 + 1.0])


def ids(vocab, words):
    return vocab.ids(pa.array(words, pa.string())).tolist()


def random_weights(vocab, seed=3):
    rows = L.first_weights(vocab).astype(np.float64)
    rows += np.random.default_rng(seed).normal(0, 0.3, rows.shape)
    return rows


def plain_probability(vocab, rows, word, beside):
    """P(id | four ids beside it), one number at a time."""
    net = L.Net(rows, vocab.pad)
    h = [math.tanh(net.bias[j] + sum(net.scale[k][j] * net.emb[i][j] for k, i in enumerate(beside)))
         for j in range(L.DIM - 1)] + [1.0]
    dot = [sum(x * y for x, y in zip(h, w, strict=True)) for w in net.out]
    p = math.exp(dot[vocab.classes[word]]) / sum(map(math.exp, dot))
    at = int(vocab.leaf[word])
    while at > 1:
        at, right = divmod(at, 2)
        z = sum(x * y for x, y in zip(h, net.nodes[vocab.base[word] + at], strict=True))
        p *= 1 / (1 + math.exp(-z if right else z))
    return p


def test_learns_what_neighbours_say(spark):
    docs = frame(spark, [(i, cycle(i, 300 + i), "a") for i in range(120)])
    words, rows = L.fit(docs)
    text = cycle(7, 200)
    shuffled = text.split()
    random.Random(1).shuffle(shuffled)
    _, sums = L.text_scores(words, rows, pa.array([text, " ".join(shuffled)]))
    assert sums[0] > sums[1] + 50
    _, first = L.text_scores(words, L.first_weights(words), pa.array([text]))
    assert sums[0] > first[0] + 50


def test_untrained_probabilities_are_shares():
    vocab = small_vocabulary()
    _, sums = L.text_scores(vocab, L.first_weights(vocab) * (np.arange(L.DIM) == L.DIM - 1),
                            pa.array(vocab.words[:50]))
    assert np.exp(sums) == pytest.approx(vocab.mass[:50] / vocab.mass.sum(), rel=1e-4)


def test_probabilities_sum_to_one_and_match_plain_numbers():
    vocab = small_vocabulary()
    rows = random_weights(vocab)
    net = L.Net(rows, vocab.pad)
    beside = [3, vocab.pad, 40, 310]
    ids = np.array([*beside[:2], 0, *beside[2:]])
    _, at, h = L.hidden(net, ids, vocab.pad)
    every = np.arange(vocab.pad)
    logp = L.log_probabilities(net, vocab, np.repeat(h, vocab.pad, axis=0), every)
    each = np.exp(logp) * vocab.kinds
    assert at.tolist() == [0] and each.sum() == pytest.approx(1)
    for word in range(0, vocab.pad, 7):
        assert each[word] == pytest.approx(plain_probability(vocab, rows, word, beside))


def test_texts_match_plain_numbers():
    vocab = small_vocabulary()
    rows = random_weights(vocab)
    texts = ["w1 W7 unknown w250 w3", "", "w9", "w2 w2 w2"]
    sizes, sums = L.text_scores(vocab, rows, pa.array(texts))
    assert sizes.tolist() == [5, 0, 1, 3]
    for text, total in zip(texts, sums.tolist(), strict=True):
        own = ids(vocab, text.lower().split())
        padded = [vocab.pad] * 2 + own + [vocab.pad] * 2
        plain = sum(math.log(plain_probability(vocab, rows, w, [padded[i], padded[i + 1],
                                                                padded[i + 3], padded[i + 4]])
                             / vocab.kinds[w]) for i, w in enumerate(own))
        assert total == pytest.approx(plain)


def test_words_of_one_class_depend_on_neighbours(spark):
    """Two words of one class: each is likelier where it stands in the corpus."""
    rng = random.Random(5)
    sides = [("red ship", "sails home"), ("old king", "rules here")]
    fill = [f"f{i}" for i in range(400)]
    often = fill + " ".join(map(" ".join, sides)).split() * 10
    lines = []
    for i in range(6000):
        k = i % 10  # x0 and x1 stand next to one another by frequency
        lines.append(" ".join(rng.choices(often, k=8)) if k > 1 else
                     f"{' '.join(rng.choices(fill, k=3))} {sides[k][0]} x{k} {sides[k][1]}")
    docs = frame(spark, [(i, " ".join(lines[i::60]), "a") for i in range(60)])
    words, rows = L.fit(docs)
    net = L.Net(rows, words.pad)
    x = np.array(ids(words, ["x0", "x1"]))
    assert words.classes[x[0]] == words.classes[x[1]]
    moved = []
    for left, right in sides:
        window = np.array(ids(words, f"{left} x0 {right}".split()))
        _, _, h = L.hidden(net, window, words.pad)
        two = L.log_probabilities(net, words, np.repeat(h[:1], 2, axis=0), x)
        moved.append(two[0] - two[1])
    assert moved[0] > moved[1] + 1


def test_gradient_matches_differences():
    vocab = small_vocabulary(40)
    ids, _ = L.windows(vocab, pa.array(["w1 w2 w30 w1 zz w12", "w5", "w30 w2 w39"]))
    first = random_weights(vocab)

    def loss(rows):
        net = L.Net(rows, vocab.pad)
        _, at, h = L.hidden(net, ids, vocab.pad)
        return -L.log_probabilities(net, vocab, h, ids[L.SIDE + at]).sum()

    learner = L.Learner(first.copy(), vocab)
    n, some, values, _ = learner.gradient(ids)
    grad = np.zeros_like(first)
    grad[some] = values
    assert n == 10 and len(set(some.tolist())) == len(some)
    learner.learn(ids)
    rng = np.random.default_rng(2)
    hit = np.argwhere(grad)
    assert len(hit) > 200
    for i, j in hit[rng.permutation(len(hit))[:120]]:
        up, down = first.copy(), first.copy()
        up[i, j] += 1e-5
        down[i, j] -= 1e-5
        assert grad[i, j] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-5)
    still = np.flatnonzero(learner.met == 0)
    assert len(still) and (learner.rows[still] == first[still]).all()


def test_words_are_those_of_python():
    texts = ["  Ab c\n\td  ", "", None, "É\u00a0x\u3000y", " ", "z" * 100_000]
    words, sizes = L.words_of(pa.array(texts))
    assert words.to_pylist() == [w for t in texts for w in (t or "").lower().split()]
    assert sizes.tolist() == [len((t or "").split()) for t in texts]


def test_vocabulary_grows_with_the_corpus(spark):
    assert [L.own_words(n) for n in (0, 10 ** 6, 10 ** 8, 10 ** 12)] == [
        L.SMALLEST, L.SMALLEST, 20_000, 2_000_000]
    words = L.vocabulary(frame(spark, [(1, "b a b", "x"), (2, "A c b", "x")]))
    assert words.words == ["b", "a", "c"] and words.mass[:3].tolist() == [3, 2, 1]
    assert ids(words, ["zz", "a"]) == [L.bucket("zz", 3, L.SMALLEST // 4), 1]


def test_more_tasks_change_little(spark):
    rows = [(i, cycle(i, 300 + i), "a") for i in range(120)]
    means = []
    for tasks in (1, 4):
        words, weights = L.fit(frame(spark, rows).repartition(tasks))
        n, sums = L.text_scores(words, weights, pa.array([cycle(5, 400)]))
        means.append(sums[0] / n[0])
    assert abs(means[0] - means[1]) < 0.5


def test_counts_cover_all_documents(spark):
    docs = frame(spark, [(1, "a A b", "x"), (2, "b c", "x"), (3, None, "x")])
    assert {(r.word, r.n) for r in L.word_counts(docs).collect()} == {("a", 2), ("b", 2), ("c", 1)}


def test_odd_rows(spark):
    out = L.op1_lm_score(frame(spark, clash=("n_words", "word", "part"))).collect()
    assert len(out) == len(ODD)
    for r in out:
        assert (r.mean_log_probability is None) == (r.n_words == 0)
        assert r.pseudo_log_likelihood <= 0
    copies = [r.pseudo_log_likelihood for r in out if r.doc_id == 4]
    assert copies[0] == copies[1]
    assert L.op1_lm_score(spark.createDataFrame([], SCHEMA)).count() == 0
