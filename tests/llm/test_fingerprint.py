import hashlib
import random

from pyspark.sql import functions as F

from quarry.llm import fingerprint as P
from quarry.llm.common import table
from tests.conftest import SF01
from tests.llm.fixtures import ODD, SCHEMA, frame, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def likeness(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    return row.select(P.likeness(F.col("a"), F.col("b"))).first()[0]


def plain_ends(data, block):
    """Trigger places by the rolling hash, a byte at a time."""
    out, window = [], [0] * P.WINDOW
    for i, byte in enumerate(data):
        window = [*window[1:], byte]
        h = mix = 0
        for age, b in enumerate(reversed(window)):
            h = (h + b * (P.WINDOW - age + 1)) & 0xFFFFFFFF
            mix ^= (b << (5 * age % 32)) & 0xFFFFFFFF
        if ((h + mix * 2654435761) & 0xFFFFFFFF) % block == block - 1:
            out.append(i)
    return out


def test_rolling_hash_matches_byte_by_byte():
    data = prose(1, 300).encode()
    h = P.rolling_hash(data)
    for block in (3, 24, 96):
        assert [i for i, x in enumerate(h.tolist()) if x % block == block - 1] == plain_ends(data, block)


def test_given_documents(spark):
    docs = table(spark, SF01, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    out = P.op9_fingerprint(docs.repartition(7)).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        own, nxt = texts[r.doc_id], texts[following[r.doc_id]]
        assert r.n_chars == len(own) and r.edited_sha256 == sha(P.edited(own, nxt))
        assert r.fingerprint == P.fingerprint(own)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    long = [r for r in out if r.n_chars > 400]
    assert sum(r.near_edited for r in long) / len(long) > 0.4
    assert sum(r.near_next for r in long) / len(long) < 0.05


def test_likeness(spark):
    text = prose(2, 900)
    a = P.fingerprint(text)
    words = text.split()
    for i in random.Random(0).sample(range(len(words)), 8):
        words[i] = "changed"
    assert likeness(spark, a, a) == 1
    assert likeness(spark, a, P.fingerprint(" ".join(words))) > 0.6
    assert likeness(spark, a, P.fingerprint(text + prose(5, 700))) > 0.3  # other block size
    assert likeness(spark, a, P.fingerprint(prose(9, 900))) == 0
    assert likeness(spark, "3::", a) == 0


def test_odd_rows(spark):
    docs = frame(spark, clash=("tie", "part", "kind", "fingerprint"))
    out = P.op9_fingerprint(docs.repartition(3)).collect()
    assert len(out) == len(ODD)
    by = {r.doc_id: r for r in out}
    assert by[1].fingerprint == by[2].fingerprint == "3::" and by[1].n_chars == 0
    assert by[None].edited_sha256 == sha(P.edited(ODD[5][1], "x" * 3000))  # the last: then the first
    assert by[7].edited_sha256 == sha(P.edited("x" * 3000, ODD[7][1]))
    assert P.op9_fingerprint(spark.createDataFrame([], SCHEMA)).count() == 0
    one = P.op9_fingerprint(frame(spark, [(1, "only one", "a")])).collect()
    assert one[0].edited_sha256 == sha("onlyonly") and one[0].near_next == 1
