import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from quarry.llm import packing as P
from quarry.llm.common import table
from tests.conftest import SF01
from tests.llm.fixtures import ODD, SCHEMA, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(text):
    from tokenizers import Tokenizer
    global TOKENIZER
    TOKENIZER = globals().get("TOKENIZER") or Tokenizer.from_file(PATH)
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [P.END]


def check(rows, texts):
    """Pieces hold the documents' ids; sequences are gapless and not too long."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= P.CAPACITY
    want = sorted((str(i), k, 4096 * k, len(c), zlib.crc32(np.array(c, "<u4").tobytes()))
                  for i, t in texts for ids in [plain(t)]
                  for k, c in enumerate(ids[a:a + 4096] for a in range(0, len(ids), 4096)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(bins)


def test_given_documents(spark):
    docs = table(spark, SF01, "documents")
    rows = P.op3_packing(docs).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= -(-sum(r.length for r in rows) // P.CAPACITY) + 1


def test_odd_rows(spark):
    rows = P.op3_packing(frame(spark, clash=("pid", "shard", "length"))).collect()
    check(rows, [(i, t) for i, t, _ in ODD])
    assert P.op3_packing(spark.createDataFrame([], SCHEMA)).count() == 0


def test_several_shards_and_levels(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 40)
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, rng.randint(1, 4096)) for i in range(300)], "pid long, length long")
    placed = {r.pid: r for r in P.place(rows).collect()}
    length = {r.pid: r.length for r in rows.collect()}
    assert set(placed) == set(length)
    fill = defaultdict(int)
    for pid in sorted(placed, key=lambda p: placed[p].offset):
        assert placed[pid].offset == fill[placed[pid].sequence_id]
        fill[placed[pid].sequence_id] += length[pid]
    assert max(fill.values()) <= P.CAPACITY
    assert len(fill) <= 1.08 * sum(length.values()) / P.CAPACITY


@pytest.mark.parametrize("lengths,most", [
    ([2500] * 3000, 3000),                                     # no two fit together
    ([1400] * 9001, 4502),                                     # two fill 0.68, three are too long
    ([2100 + 7 * i % 1900 for i in range(2800)] + [300] * 400, 2800)])
def test_pieces_that_do_not_combine_settle(spark, monkeypatch, lengths, most):
    one_level = P.pack_shards

    def counted(rows, n_shards, level):
        assert level < 12, "goes on for ever"
        return one_level(rows, n_shards, level)

    monkeypatch.setattr(P, "pack_shards", counted)
    rows = spark.createDataFrame(list(enumerate(lengths)), "pid long, length long")
    placed = P.place(rows).collect()
    assert sorted(r.pid for r in placed) == list(range(len(lengths)))
    fill = defaultdict(int)
    for r in sorted(placed, key=lambda r: r.offset):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += lengths[r.pid]
    assert max(fill.values()) <= P.CAPACITY and len(fill) <= most


@pytest.mark.parametrize("text", [
    "Hello,, it's <|endoftext|> foo.<|startoftext|>bar <|EndOfText|>", "a\x1cz\x85w　q",
    "don't.he'll,we'd... 12,3.4 ,. .,a,b", "İstanbul ΣΑΣ, ſ's é,.x ́y"])
def test_words_encode_as_the_whole_text(text):
    got = np.frombuffer(P.encoder(PATH).encode([text])[0], "<u4").tolist()
    assert got == plain(text)


def test_a_full_memo_keeps_what_is_met_again(monkeypatch):
    monkeypatch.setattr(P, "MEMO_WORDS", 8)
    enc, asked = P.encoder(PATH), []
    learn = enc.learn
    monkeypatch.setattr(enc, "learn", lambda words: (asked.extend(words), learn(words))[1])
    for k in range(12):
        some = f"often {chr(97 + k)}one {chr(97 + k)}two {chr(97 + k)}three {chr(97 + k)}four"
        assert np.frombuffer(enc.encode([some])[0], "<u4").tolist() == plain(some)
    assert asked.count(b"often") == 1


def test_encoders_go_with_their_stage():
    """A worker's encoder hangs on a broadcast, not on the module, where every
    later stage in that worker would carry its memo."""
    import pickle
    held = [v for v in vars(P).values() if isinstance(v, (P.Encoder, dict)) and v is not vars(P)["__builtins__"]]
    assert not held
    kept = pickle.loads(pickle.dumps(P.Kept(PATH)))
    assert kept.get() is kept.get()


def test_crossover_keeps_every_piece():
    rng = random.Random(1)
    lengths = [rng.randint(1, 3000) for _ in range(120)]
    parents = []
    for _ in range(2):
        one, items = P.Bins(lengths), list(range(120))
        rng.shuffle(items)
        for i in items[:30]:
            one.add([i])
        one.best_fit(items[30:])
        parents.append(one)
    child = P.mutate(P.crossover(*parents, rng), rng)
    assert sorted(i for b in child.bins for i in b) == list(range(120))
    assert all(f == sum(lengths[i] for i in b) <= P.CAPACITY
               for b, f in zip(child.bins, child.fill, strict=True))
