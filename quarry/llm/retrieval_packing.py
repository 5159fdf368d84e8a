"""Packing by lexical retrieval: related documents share a window.

Texts become token ids. Whole windows of a document are sequences of their own;
its last, shorter piece is packed with pieces of other documents. These are
dealt into shards of ``SHARD`` pieces in the order of a MinHash of their ids, so
that copies and related texts meet, and equal ones are still dealt over many
tasks by a number of their own. Every shard is an inverted index of BM25
weights; their statistics (in how many pieces an id occurs, mean length) count
the pieces of all documents, a table no longer than the vocabulary. A seed's
unused neighbours fill its window, best first: the first of the best ``LOOK``
that fits goes in whole, and when none fits the best is cut to fill the window
and the rest of it is the next seed. What a shard has left over moves on into
the task's next shard, and a task's last pieces, shorter than a window, become
sequences of powers of two: no sequence needs padding.

Ids are those of the ``tokenizers`` file: its special token in a text becomes
its id. The work is done by the rank file of the same vocabulary, which is four
times as fast, and words met before are remembered; a test compares both on
every code point. Texts that the faster library refuses (runs of white space
too long for its expression) go to the other.

Edge cases: a null or empty text is the single end id; repeated rows are packed
once each; null ids of documents are kept, of any type; a text of any length
is cut into windows; pieces without a common id still fill windows, in shard
order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarry.llm.common import slices, stored, texts_of
from quarry.llm.packing import bytes_of, taken

WINDOW = 1024
END = 0                   # id after every document
SHARD = 1024              # pieces of a shard
TASK_SHARDS = 4           # shards of a packing task, about
LOOK = 16                 # neighbours of which the first that fits is taken
K1, B = 1.2, 0.75
KEEP = 0.75               # share of a shard's pieces unused at which the others leave its index
TEXT = 4_000_000          # characters of text encoded at a time
MEMO_WORDS = 700_000      # encoded words a worker remembers at a time
SPECIAL = "<|endoftext|>"

#: White space after a blank, or a blank at the end: such texts are not cut at blanks.
_ODD = re.compile(r" \s| \Z")


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit numbers. A blank before
    anything but white space always begins a piece of the pattern, so a text's
    ids are those of its words in a row."""

    def __init__(self, ranks: str, tokenizer: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                      special_tokens={})
        self.slow = Tokenizer.from_file(tokenizer)
        self.slow.encode_special_tokens = True
        self.special = np.array([self.slow.token_to_id(SPECIAL)], "<u2").tobytes()
        top = max(max(table.values()), self.slow.get_vocab_size() - 1)
        if top >= 1 << 16:
            raise ValueError(f"ids up to {top} don't fit 16 bits")
        self.begins = np.zeros(top + 1, bool)  # ids that begin with a blank
        self.begins[[i for b, i in table.items() if b[:1] == b" "]] = True
        self.memo: dict[bytes, bytes] = {}  # by UTF-8

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u2")
        except ValueError:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u2")

    def whole(self, text: str) -> bytes:
        return self.special.join(self.ids(part).tobytes() for part in text.split(SPECIAL))

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of the words, each with a blank before it."""
        for at in range(0, len(words), 20_000):
            some = words[at:at + 20_000]
            ids = self.ids((b" " + b" ".join(some)).decode())
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) != len(some):
                self.memo.update((w, self.ids((b" " + w).decode()).tobytes()) for w in some)
                continue
            raw, ends = ids.tobytes(), np.append(starts * 2, 2 * len(ids)).tolist()
            self.memo.update(zip(some, (raw[a:b] for a, b in zip(ends, ends[1:], strict=False)),
                                 strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts with the end id."""
        odd = [bool(_ODD.search(t)) or SPECIAL in t for t in texts]
        cut = iter(self.of_words([t for t, o in zip(texts, odd, strict=True) if not o]))
        end = np.array([END], "<u2").tobytes()
        return [self.whole(t) + end if o else next(cut) for t, o in zip(texts, odd, strict=True)]

    def of_words(self, texts: list[str]) -> list[bytes]:
        """The same of texts that may be cut at every blank. Arrow cuts them and
        numbers their words; Python sees the distinct words only, and every text's
        first one, which has no blank before it."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        numbered = split.flatten().dictionary_encode()
        which, upto = numbered.indices.to_numpy(), split.offsets.to_numpy()
        heads, words = upto[:-1], bytes_of(numbered.dictionary)
        used = np.zeros(len(words), bool)
        used[np.delete(which, heads)] = True
        used = np.flatnonzero(used).tolist()
        words = [words[k] for k in used]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        ids = list(map(self.memo.get, words))
        gaps = [k for k, x in enumerate(ids) if x is None]
        self.learn([words[k] for k in gaps])
        for k in gaps:
            ids[k] = self.memo[words[k]]
        place = np.zeros(len(numbered.dictionary), np.int64)
        place[used] = np.arange(len(used))
        which = place[which]
        which[heads] = len(ids) + np.arange(len(texts))
        ids += [self.ids(t.split(" ", 1)[0]).tobytes() for t in texts]
        which = np.insert(which, upto[1:], len(ids))
        ids.append(np.array([END], "<u2").tobytes())
        out, behind = taken(np.frombuffer(b"".join(ids), "<u2"),
                            np.fromiter(map(len, ids), np.int64, len(ids)) // 2, which)
        ends = (2 * behind[upto[1:] + np.arange(len(texts))]).tolist()
        raw = out.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


_encoders: dict[tuple[str, str], Encoder] = {}  # one per worker process, reused by its tasks


def encoder(ranks: str, tokenizer: str) -> Encoder:
    if (ranks, tokenizer) not in _encoders:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[ranks, tokenizer] = Encoder(ranks, tokenizer)
    return _encoders[ranks, tokenizer]


def clocks() -> np.ndarray:
    """A place for every id, rarer ids (later merges) earlier: the first id of
    a piece in this order is its weighted MinHash."""
    n = 1 << 16
    weight = np.log(np.arange(n) + 2.0)
    return np.argsort(np.argsort(np.random.default_rng(11).exponential(size=n) / weight))


def piece_fields(docs: DataFrame) -> list[StructField]:
    return [StructField("doc_id", docs.schema["doc_id"].dataType),
            *StructType.fromDDL("start long, length long, ids_crc32 long, doc_tokens long, "
                                "sequence_id long, offset long").fields]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(docs: DataFrame, ranks: str, tokenizer: str) -> DataFrame:
    """All pieces: whole windows with an even sequence number, and last pieces
    (``ids`` not null) with a number of their own and a MinHash; written once,
    so that the numbers hold."""
    schema = StructType([*piece_fields(docs),
                         *StructType.fromDDL("ids binary, number long, h int").fields])
    id_type = docs.limit(0).select("doc_id").toArrow().schema.field(0).type

    def run(batches):
        from pyspark import TaskContext
        enc, order = encoder(ranks, tokenizer), clocks()
        number = TaskContext.get().partitionId() << 33
        for part in slices(batches, most=TEXT):
            rows, of = [], []
            for at, raw in enumerate(enc.encode(texts_of(part))):
                ids = np.frombuffer(raw, "<u2")
                n, rest = len(ids), len(ids) % WINDOW
                for start in range(0, n - rest, WINDOW):
                    rows.append((start, WINDOW, crc(ids[start:start + WINDOW]), n, 2 * number, 0,
                                 None, None, None))
                    number += 1
                    of.append(at)
                if rest:
                    own = ids[n - rest:]
                    rows.append((n - rest, rest, None, n, None, None, own.tobytes(), number,
                                 int(order[own].min())))
                    number += 1
                    of.append(at)
            types = [pa.int64()] * 6 + [pa.binary(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(id_type).take(pa.array(of))]
                + [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                names=schema.names)

    return stored(docs.select("doc_id", "text").mapInArrow(run, schema), "encoded")


@dataclass
class Statistics:
    """BM25 statistics of the pieces of all documents."""
    idf: np.ndarray
    mean: float


def statistics(last: DataFrame) -> Statistics:
    """Ids of all pieces counted in their tasks; one row per id to the driver."""
    def run(batches):
        df, n = np.zeros(1 << 16, np.int64), 0
        for batch in batches:
            for ids in batch.column("ids"):
                df[np.unique(np.frombuffer(ids.as_buffer(), "<u2"))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["id", "df"])

    facts = last.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    df = np.zeros(1 << 16)
    for r in last.select("ids").mapInArrow(run, "id long, df long").groupBy("id") \
            .agg(F.sum("df").alias("df")).collect():
        df[r.id] = r.df
    return Statistics(np.log1p((facts.n - df + 0.5) / (df + 0.5)), facts.mean or 1.0)


@dataclass
class Piece:
    """A last piece or what is left of it: token ids and where they come from."""
    doc_id: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        return (Piece(self.doc_id, self.start, self.ids[:n], self.doc_tokens),
                Piece(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens))


class Shard:
    """Inverted index of the BM25 weights of some pieces."""

    def __init__(self, pieces: list[Piece], stats: Statistics):
        sizes = np.array([len(p.ids) for p in pieces])
        ids = np.concatenate([p.ids for p in pieces]).astype(np.int64)
        of = np.repeat(np.arange(len(pieces)), sizes)
        code, tf = np.unique(ids * len(pieces) + of, return_counts=True)  # by id, then piece
        self.of, own = code % len(pieces), code // len(pieces)
        norm = K1 * (1 - B + B * sizes[self.of] / stats.mean)
        self.weight = stats.idf[own] * tf * (K1 + 1) / (tf + norm)
        self.first = np.searchsorted(own, np.arange((1 << 16) + 1))
        self.count = len(pieces)

    def keep(self, unused: np.ndarray) -> None:
        """Only the weights of unused pieces; their scores stay the same."""
        on = unused[self.of]
        self.first = np.append(0, np.cumsum(on))[self.first]
        self.of, self.weight = self.of[on], self.weight[on]

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """BM25 of every piece for the distinct ids of a seed."""
        seed = np.unique(ids)
        first, last = self.first[seed], self.first[seed.astype(np.int64) + 1]
        size = last - first
        at = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        return np.bincount(self.of[at], self.weight[at], self.count)


def fill(pieces: list[Piece], stats: Statistics) -> Iterator[list[Piece]]:
    """Full windows from the pieces, each a seed and its neighbours; at last
    the pieces left, shorter than a window."""
    index = Shard(pieces, stats)
    pieces, sizes = list(pieces), np.array([len(p.ids) for p in pieces])
    unused = np.ones(len(pieces), bool)
    left, at, seed, held = int(sizes.sum()), 0, None, len(pieces)
    while left >= WINDOW:
        if seed is None:
            while not unused[at]:
                at += 1
            seed, unused[at] = pieces[at], False
        window, room = [seed], WINDOW - len(seed.ids)
        seed = None
        free = np.flatnonzero(unused)
        if len(free) < KEEP * held:
            index.keep(unused)
            held = len(free)
        score = index.scores(window[0].ids)
        best = free[np.argsort(-score[free], kind="stable")]
        while room:
            near = best[:LOOK]
            whole = np.flatnonzero(sizes[near] <= room)
            k = int(whole[0]) if len(whole) else 0
            i = int(near[k])
            unused[i] = False
            best = np.delete(best, k)
            if len(whole):
                window.append(pieces[i])
                room -= int(sizes[i])
            else:
                head, seed = pieces[i].cut(room)
                window.append(head)
                room = 0
        left -= WINDOW
        yield window
    yield ([seed] if seed else []) + [pieces[i] for i in np.flatnonzero(unused)]


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces in a row, cut into sequences of powers of two, largest first."""
    left = sum(len(p.ids) for p in pieces)
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left, window = left - room, []
        while room:
            p = pieces.pop()
            if len(p.ids) > room:
                p, rest = p.cut(room)
                pieces.append(rest)
            window.append(p)
            room -= len(p.ids)
        yield window


def task_windows(shards: Iterator[list[Piece]], stats: Statistics) -> Iterator[list[Piece]]:
    """Windows of a task's shards; what a shard leaves moves on to the next."""
    rest: list[Piece] = []
    for pieces in shards:
        windows = list(fill(rest + pieces, stats))
        rest = windows.pop()
        yield from windows
    yield from powers(rest)


def pack(docs: DataFrame, ranks: str, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and place in it; with
    ``with_ids`` also its ids (little-endian, 16 bits), null for whole windows
    of a document."""
    pieces = encoded(docs, ranks, tokenizer)
    last = pieces.where(F.col("ids").isNotNull())
    stats = statistics(last)
    fields = piece_fields(docs) + ([StructField("ids", pieces.schema["ids"].dataType)] if with_ids else [])
    schema = StructType(fields)
    id_type = docs.limit(0).select("doc_id").toArrow().schema.field(0).type

    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33

        def shards():
            waiting = []
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))
                for doc_id, start, ids, n in zip(*columns, strict=True):
                    waiting.append(Piece(doc_id, start, np.frombuffer(ids, "<u2"), n))
                    if len(waiting) == SHARD:
                        yield waiting
                        waiting = []
            if waiting:
                yield waiting

        out = []

        def batch_of():
            types = [id_type] + [pa.int64()] * 6 + [pa.binary()] * with_ids
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                names=schema.names)

        for window in task_windows(shards(), stats):
            offset = 0
            for p in window:
                out.append((p.doc_id, p.start, len(p.ids), crc(p.ids), p.doc_tokens, 2 * number + 1, offset)
                           + ((p.ids.tobytes(),) if with_ids else ()))
                offset += len(p.ids)
            number += 1
            if len(out) >= 10_000:
                yield batch_of()
                out = []
        if out:
            yield batch_of()

    tasks = max(1, last.count() // (TASK_SHARDS * SHARD))
    packed = (last.select("doc_id", "start", "doc_tokens", "ids", "h", "number")
              .repartitionByRange(tasks, "h", "number").sortWithinPartitions("h", "number")
              .mapInArrow(run, schema))
    whole = pieces.where(F.col("ids").isNull()).select(*schema.names)
    return whole.unionByName(packed)


def op11_retrieval_packing(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                public_tokenizers.path("byte_bpe_50k.json"))
