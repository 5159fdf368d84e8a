import hashlib

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import bpe as B
from quarry.llm.common import table
from tests.conftest import SF001
from tests.llm.fixtures import ODD, SCHEMA, frame

RANKS = B.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                            special_tokens={})


def want(doc_id, text):
    text = text or ""
    ids = LIBRARY.encode_ordinary(text)
    return (str(doc_id), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def got(rows):
    return sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)


def test_given_documents_with_few_common_words(spark, monkeypatch):
    monkeypatch.setattr(B, "COMMON", 500)  # most words are folded in their rows
    docs = table(spark, SF001, "documents")
    assert got(B.op4_byte_bpe(docs).collect()) == sorted(
        want(r.doc_id, r.text) for r in docs.collect())


def test_odd_rows(spark):
    rows = [*((i, (t or "")[:400] if t and len(t) > 5000 else t, s) for i, t, s in ODD),
            (9, "don't  stop\x1c\x85 ǅ \n\n x½ Ⅷ 'S we'LL \U0001f642\U0001f642 　", "c"),
            (10, "ab" * 60 + " " * 70 + "!" * 80, "c")]
    docs = frame(spark, rows, clash=("rare", "marked", "n_tokens"))
    assert got(B.op4_byte_bpe(docs).collect()) == sorted(want(i, t) for i, t, _ in rows)
    assert B.op4_byte_bpe(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_task_needs_one_python_worker(spark):
    made = B.op4_byte_bpe(frame(spark, ODD[:3]))
    assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_rank_map_finds_every_pair():
    m = B.RankMap(RANKS)
    pairs = [(RANKS[t[:k]], RANKS[t[k:]], r) for t, r in list(RANKS.items())[:5000]
             for k in range(1, len(t)) if t[:k] in RANKS and t[k:] in RANKS]
    for a, b, r in pairs:
        key = a << 16 | b
        assert (key << 16 | r) in (m.tables[0][key % m.sizes[0]], m.tables[1][key % m.sizes[1]])


def test_filled():
    import numpy as np
    marked = np.array([5, -1, 6, -2, -1], "<i4").tobytes()
    assert B.filled(marked, [[7, 8], [9]]).tolist() == [5, 7, 8, 6, 9, 7, 8]
    assert B.filled(b"", []).tolist() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1.,'s \n\t\x1c　é", max_size=24))
def test_stretches_hold_the_words(text):
    split = B.Splitter(public_tokenizers.PATTERN)
    own = split.stretches(text)
    if own is not None:
        words = split.words(own[0]) + [w for s in own[1:] for w in split.after_space(s)]
        assert words == split.words(text)
