"""Toxicity (noisy-or over sentences) and line CRF: held-out accuracy on the
given labels, the odd rows, and the pieces of both models."""
import math
import zlib

import numpy as np
import pytest

from quarry.llm import quality_crf as Q
from quarry.llm import toxicity as T
from quarry.llm.common import table
from tests.conftest import SF01
from tests.llm.fixtures import LABELS, ODD, SCHEMA, frame


@pytest.mark.parametrize("op,mod,held,label,least", [
    (T.op2_toxicity, 3, 1, "toxic", 0.9), (Q.op8_quality_crf, 5, 0, "quality", 0.95)])
def test_held_out_accuracy(spark, op, mod, held, label, least):
    labels = {r.doc_id: r[label] for r in table(spark, SF01, "labels").collect()}
    out = op(table(spark, SF01, "documents"), table(spark, SF01, "labels")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == held) for r in out)
    assert all(0 <= r.score <= 1 for r in out)
    checked = [(labels[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in labels]
    assert len(checked) > 50
    assert sum(a == b for a, b in checked) / len(checked) >= least


@pytest.mark.parametrize("op", [T.op2_toxicity, Q.op8_quality_crf])
def test_odd_rows(spark, op):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None)], LABELS)
    out = op(frame(spark, clash=("score", "held_out", "y", "h")), labels).collect()
    assert len(out) == len(ODD)
    copies = [r.score for r in out if r.doc_id == 4]
    assert copies[0] == copies[1]
    assert op(spark.createDataFrame([], SCHEMA), labels).count() == 0
    none = op(frame(spark), labels.limit(0)).collect()  # nothing to learn from
    assert {round(r.score, 6) for r in none} == ({0.0} if op is T.op2_toxicity else {0.5})


def test_noisy_or():
    z = np.array([-2.0, 0.5, 1.0])
    p = 1 / (1 + np.exp(-z))
    assert T.noisy_or(z) == pytest.approx(1 - np.prod(1 - p))
    assert T.noisy_or(np.array([])) == 0


def test_offending_sentences_are_located():
    clean = ["the sun is up. we walk home.\nall is calm now.", "a quiet day! what else? you are a friend."]
    bad = ["the sun is up. you are a wretch. all is calm.", "we walk. wretched wretch that you are!"]
    model = T.train([(t, 0) for t in clean * 20] + [(t, 1) for t in bad * 20])
    text = "All is calm now. What a wretch! We walk home."
    found = [text[s:e] for s, e, z in model.sentences(text) if z >= 0]
    assert [f.strip() for f in found] == ["What a wretch!"]


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    doc = np.array([0, 0, 0, 1, 2, 2])
    unary, trans = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    got = Q.marginals(*Q.forward_backward(unary, trans, Q.chains(doc)))
    for d in range(3):
        at = np.flatnonzero(doc == d)
        total, good = 0.0, np.zeros(len(at))
        for path in np.ndindex(*[2] * len(at)):
            s = sum(unary[i, y] for i, y in zip(at, path, strict=True))
            s += sum(trans[a, b] for a, b in zip(path, path[1:], strict=False))
            total += math.exp(s)
            good += math.exp(s) * np.array(path)
        assert got[at] == pytest.approx(good / total)


def test_line_features_do_not_cross_documents():
    one = Q.design(*Q.line_features(["a b\nC!! D!!\n"])[:2])
    both = Q.design(*Q.line_features(["x | y", "a b\nC!! D!!\n", "q"])[:2])
    assert (both[1:4] == one).all()


def test_stages_keep_columns_and_rows(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    scored = {r.doc_id: r.predicted for r in T.op2_toxicity(docs, labels).collect()}
    kept = T.clean_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, p in scored.items() if not p}


def test_training_holds_little_beside_its_sample(monkeypatch):
    import tracemalloc
    for op in (T, Q):
        monkeypatch.setattr(op, "ROUNDS", 2)
    rng = np.random.default_rng(3)
    names = np.array([f"w{k}" for k in range(3000)])
    rows = [("\n".join(" ".join(rng.choice(names, 30)) + "." for _ in range(30)), k % 2)
            for k in range(1500)]
    for op, most in ((Q, 800), (T, 900)):
        tracemalloc.start()
        op.train(rows)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * 1500 * 30  # bytes for each of the lines


def test_sums_by_parts_are_those_of_the_whole():
    rng = np.random.default_rng(5)
    doc = np.sort(rng.integers(0, 50, 400))
    cols = Q.design(rng.integers(0, Q.BINS, (400, Q.N_FEATURES)), doc).astype(np.int16)
    err = rng.normal(size=400)
    flat = np.where(cols < 0, Q.WIDTH + 1, cols).ravel()
    whole = np.bincount(flat, np.repeat(err, cols.shape[1]), Q.WIDTH + 2)[:Q.WIDTH]
    assert (Q.gradient(cols, err) == whole).all()
    sent = np.sort(np.concatenate([np.arange(400), rng.integers(0, 400, 900)]))
    T_STRETCH, T.STRETCH = T.STRETCH, 100
    try:
        parts = T.stretches(sent, doc)
    finally:
        T.STRETCH = T_STRETCH
    assert len(parts) > 5 and parts[0][0] == 0 and parts[-1][1] == len(sent)
    assert all(b == c for (_, b), (c, _) in zip(parts, parts[1:], strict=False))
    assert all(doc[sent[b - 1]] < doc[sent[b]] for _, b in parts[:-1])
    assert T.stretches(sent[:0], doc[:0]) == []
