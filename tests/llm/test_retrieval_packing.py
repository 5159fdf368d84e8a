import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import retrieval_packing as R

from .fixtures import ODD, frame, prose

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


def library(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(tokenizer, docs, rows):
    """Every id of every document in exactly one piece, sequences gapless and
    full or of a power of two; gives the sequences."""
    want = sorted((i, *library(tokenizer, t)) for i, t in docs)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_seq[r.sequence_id].append(r)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0
    spans = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows)
    made = []
    for i, *ids in want:  # cut each document as its pieces say
        starts = sorted({(s, n) for d, s, n, _ in spans if d == i and s + n <= len(ids)})
        made.append((i, ids, starts))
    if len({i for i, _ in docs}) == len(docs):
        own = sorted((i, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))
                     for i, ids, starts in made for s, n in starts)
        assert own == spans
        for i, ids, starts in made:
            at = 0
            for s, n in starts:
                assert s == at
                at += n
            assert at == len(ids)
    assert sum(r.length for r in rows) == sum(len(w) - 1 for w in want)
    return by_seq


def test_encoder_equals_library(tokenizer):
    enc = R.encoder(RANKS, JSON)
    rng = random.Random(4)
    signs = ["a", "The", "'s", " ", "  ", "\n", "\t", " ", "　", "é", "😀", "中", "1", "...", "<|endoftext|>",
             "\x1c", "\x85", "_", "don't", "\r\n", " "]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += [prose(i, 300) for i in range(20)] + [" " * 200_000, "x" * 50_000, " a" * 1000, "b ", " ", ""]
    got = enc.encode(texts)
    for text, raw in zip(texts, got, strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == library(tokenizer, text), text[:50]


def test_packs_given_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    rows = R.op11_retrieval_packing(docs).collect()
    seqs = check(tokenizer, [(r.doc_id, r.text) for r in docs.collect()], rows)
    short = [rs for rs in seqs.values() if sum(r.length for r in rs) < 1024]
    assert len(short) <= 10  # one task's last pieces


def test_odd_rows_and_empty_table(spark, tokenizer):
    docs = frame(spark, clash=("ids", "number", "h", "length", "sequence_id"))
    check(tokenizer, [(i or 0, t) for i, t, _ in ODD],
          R.op11_retrieval_packing(docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))).collect())
    rows = R.op11_retrieval_packing(docs).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, None, 5, 6, 7}
    assert sum(r.length for r in rows if r.doc_id == 4) == 2 * len(library(tokenizer, "one two"))
    assert R.op11_retrieval_packing(frame(spark, [])).count() == 0
    named = R.op11_retrieval_packing(frame(spark).withColumn("doc_id", F.col("doc_id").cast("string")))
    assert named.schema["doc_id"].dataType.typeName() == "string" and named.count() >= len(ODD)


def piece(key, ids):
    return R.Piece(key, 0, np.array(ids, "<u2"), len(ids))


def brute_scores(pieces, seed, stats):
    out = []
    for p in pieces:
        s = 0.0
        for t in set(seed):
            tf = list(p.ids).count(t)
            norm = R.K1 * (1 - R.B + R.B * len(p.ids) / stats.mean)
            s += stats.idf[t] * tf * (R.K1 + 1) / (tf + norm) if tf else 0
        out.append(s)
    return out


def test_scores_are_bm25(spark):
    rng = random.Random(2)
    pieces = [piece(k, rng.choices(range(40), k=rng.randint(1, 60))) for k in range(50)]
    df = np.zeros(1 << 16)
    for p in pieces:
        df[np.unique(p.ids)] += 1
    mean = sum(len(p.ids) for p in pieces) / len(pieces)
    stats = R.Statistics(np.log1p((len(pieces) - df + 0.5) / (df + 0.5)), mean)
    shard = R.Shard(pieces, stats)
    for p in pieces[:10]:
        assert np.allclose(shard.scores(p.ids), brute_scores(pieces, p.ids.tolist(), stats))
    rows = [(p.ids.tobytes(), len(p.ids)) for p in pieces]
    own = R.statistics(spark.createDataFrame(rows, "ids binary, length long").repartition(3))
    assert np.allclose(own.idf, stats.idf) and own.mean == mean


def test_neighbours_share_windows_and_copies_of_one_text_spread():
    rng = random.Random(3)
    topics = [range(k * 100, k * 100 + 100) for k in range(8)]
    pieces = [piece(k, rng.choices(topics[k % 8], k=rng.randint(100, 400))) for k in range(300)]
    stats = R.Statistics(np.ones(1 << 16), 250.0)
    windows = list(R.task_windows(iter([pieces[:150], pieces[150:]]), stats))
    full = [w for w in windows if sum(len(p.ids) for p in w) == R.WINDOW]
    pure = sum(len({p.doc_id % 8 for p in w}) == 1 for w in full)
    assert pure > 0.7 * len(full) > 0
    assert sum(len(p.ids) for w in windows for p in w) == sum(len(p.ids) for p in pieces)
    same = [piece(k, range(700)) for k in range(100)]
    windows = list(R.task_windows(iter([same]), stats))
    assert sum(len(p.ids) for w in windows for p in w) == 70_000
    assert all(sum(len(p.ids) for p in w).bit_count() == 1 for w in windows)


def test_pieces_with_ids(spark, tokenizer):
    docs = spark.createDataFrame([(i, prose(i, 80)) for i in range(60)], "doc_id long, text string")
    rows = R.pack(docs, RANKS, JSON, with_ids=True).collect()
    of = {i: library(tokenizer, prose(i, 80)) for i in range(60)}
    assert rows and all(np.frombuffer(r.ids, "<u2").tolist() == of[r.doc_id][r.start:r.start + r.length]
                        for r in rows if r.ids is not None)


def test_a_word_that_repeats_is_looked_up_once():
    class Memo(dict):
        looked = 0

        def get(self, *key):
            self.looked += 1
            return super().get(*key)

        def __getitem__(self, key):
            self.looked += 1
            return super().__getitem__(key)

    enc = R.Encoder(RANKS, JSON)
    texts = ["one two three " * 500 + "four", " begins with a blank", "alone", "", "\n\nodd one\ttwo x", "é two Ωmega"]
    plain = [enc.whole(t) + b"\0\0" for t in texts]
    enc.memo = Memo()
    assert enc.encode(texts) == plain
    assert enc.memo.looked < 60  # 1,500 words and more
    assert enc.encode(texts[::-1]) == plain[::-1] and enc.encode([]) == []


def test_index_without_used_pieces_gives_the_same_scores():
    rng = np.random.default_rng(2)
    pieces = [R.Piece(k, 0, rng.integers(0, 300, 80).astype("<u2"), 80) for k in range(60)]
    stats = R.Statistics(rng.random(1 << 16), 80.0)
    index, unused = R.Shard(pieces, stats), rng.random(60) < 0.4
    before, size = [index.scores(p.ids)[unused] for p in pieces], len(index.of)
    index.keep(unused)
    assert len(index.of) < size / 2
    assert all((index.scores(p.ids)[unused] == s).all() for p, s in zip(pieces, before, strict=True))
