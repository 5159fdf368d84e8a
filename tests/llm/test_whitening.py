import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def plain(rows):
    """(x, n, sums, eigenvalues, vectors) by numpy over all rows at once."""
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov((fit - sums / n).T, bias=True))
    return x, n, sums, values[::-1], vectors[:, ::-1]


def check(rows, got):
    x, n, sums, values, vectors = plain(rows)
    k = min(16, x.shape[1])
    got = sorted(((r.vec_id, r.component, r) for r in got), key=lambda t: t[:2])
    assert len(got) == len(rows) * k and {r.n for *_, r in got} == {n}
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    z = np.array([r.whitened for *_, r in got]).reshape(len(rows), k)
    want = ((x - sums / n) @ vectors[:, :k] / np.sqrt(values[:k]))[order]
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * sign).max() < 1e-8
    own = [r.deviation for *_, r in got][::k]
    assert own == [int(v) for v in ((n * x - sums) ** 2).sum(axis=1)[order]]
    share = np.array([r.explained for *_, r in got]).reshape(-1, k)
    assert np.abs(share / (values[:k] / values.sum()) - 1).max() < 1e-9
    assert got[0][2].identity_error < 1e-9


@pytest.mark.parametrize("d", [3, 20])
def test_against_numpy_with_copies(spark, d, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(d)
    base = rng.normal(size=(150, d)).astype(np.float32).tolist()
    rows = [(i, base[i % 150] if i % 3 else base[7]) for i in range(400)]  # a third is one vector
    check(rows, W.op13_whitening(frame(spark, rows)).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, v) for i, v in enumerate(rng.normal(size=(40, 4)).astype(np.float32).tolist())]
    odd = [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [1.0, float("nan"), 0.0, 0.0]),
           (103, [float("inf"), 0.0, 0.0, 0.0]), (104, [1.0, 2.0]), (105, [])]
    check(good, W.op13_whitening(frame(spark, good + odd)).collect())
    twice = W.op13_whitening(frame(spark, good + [good[0], (None, good[1][1])]))
    counts = {r.vec_id: r["count"] for r in twice.groupBy("vec_id").count().collect()}
    assert counts[0] == 8 and counts[None] == 4 and counts[5] == 4
    assert twice.agg(F.max("n")).first()[0] == 40  # copies count once in the fit


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    got = W.op13_whitening(frame(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0


def test_constant_column_is_no_component(spark):
    rows = [(i, [float(i % 7), 3.0, float(i % 5)]) for i in range(35)]
    got = W.op13_whitening(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9


def test_deviation_stays_exact_or_is_null():
    x = np.array([[0, 10 ** 6], [2, 10 ** 6]], np.int64)
    n, sums = 10 ** 12, [10 ** 12, 10 ** 18]
    centred, own = W.deviations(x, n, sums)
    assert own == [None, None] and np.allclose(centred, [[-1, 0], [1, 0]])
    assert W.deviations(x, 10 ** 9, [10 ** 9, 10 ** 15])[1] == [10 ** 18, 10 ** 18]


def test_block_size_is_bounded():
    assert W.block_rows(100, 64) == W.BLOCK_ROWS
    assert W.block_rows(10 ** 12, 64) * 64 * 8 <= W.BLOCK_BYTES
    assert W.block_rows(10 ** 6, 10 ** 7) == 1
