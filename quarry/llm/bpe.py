"""Byte-level BPE encoding and decoding.

A text is cut into words by the tokenizer's pattern. The merges of a word are
folded with Spark's higher-order functions: the word is an array of its bytes,
and each step joins the leftmost pair of the lowest rank, looked up in the rank
map, a literal of the plan.

Words are folded once where they repeat: the ``COMMON`` most frequent distinct
words of the corpus are folded first and handed to the tasks (a table of
bounded size); what a document has besides is folded in the document's own
row, each distinct word once. So nothing is shuffled but word counts, and every
word is encoded exactly. Decoding joins the byte strings of the ids.

Edge cases: a null or empty text has no ids and the digests of nothing;
repeated rows give equal rows; null ids are kept; an empty table gives an
empty result; other columns are ignored. A word of n bytes takes up to n steps
of n lookups.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, discard, map_rows, slices, stored, texts_of

COMMON = 500_000     # distinct words at most whose ids the tasks are given
COMMON_BYTES = 48    # longer words are folded in their rows
COUNTED = 200_000    # distinct stretches that a task counts before it hands them on
KNOWN = 150_000      # stretches whose ids a task remembers at a time


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankMap:
    """The rank map as literals of the plan: the rank of the joined bytes by
    the ids of the two parts. Two tables of prime size; every pair of parts
    stands at its remainder in one of them (cuckoo hashing), packed with its
    rank into one number."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {(ranks[t[:k]] << 16) | ranks[t[k:]]: rank for t, rank in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.sizes = _two_primes(int(1.25 * len(pairs)) + 16)
        tables = [[-1] * n for n in self.sizes]
        for key, rank in pairs.items():
            entry, at = (key << 16) | rank, 0
            for _ in range(500):
                n = self.sizes[at]
                slot = (entry >> 16) % n
                entry, tables[at][slot] = tables[at][slot], entry
                if entry < 0:
                    break
                at = 1 - at
            else:
                raise ValueError("no place for a pair")  # prime sizes at this load: not met
        self.tables = tables
        self.of_byte = [ranks[bytes([b])] for b in range(256)]

    def literal(self) -> Column:
        """The tables; ``bind`` it, so that the plan holds them once."""
        return F.struct(*[F.from_json(F.lit(json.dumps(t)), f"array<{kind}>").alias(name)
                          for name, kind, t in (("one", "bigint", self.tables[0]),
                                                ("two", "bigint", self.tables[1]),
                                                ("bytes", "int", self.of_byte))])

    def rank(self, table: Column, a: Column, b: Column) -> Column:
        """Rank of two parts joined, by their ids; null if that is no token."""
        key = a.cast("long") * 65536 + b
        found = [F.element_at(table[name], (F.pmod(key, F.lit(n)) + 1).cast("int"))
                 for name, n in zip(("one", "two"), self.sizes, strict=True)]
        return F.coalesce(*[F.when(F.shiftright(e, 16) == key, e.bitwiseAND(F.lit(65535)).cast("int"))
                            for e in found])


def _two_primes(least: int) -> tuple[int, int]:
    found: list[int] = []
    n = least | 1
    while len(found) < 2:
        if all(n % d for d in range(3, int(n ** 0.5) + 1, 2)):
            found.append(n)
        n += 2
    return found[0], found[1]


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(ranks: RankMap, table: Column, word: Column) -> Column:
    """Ids of one word, a binary column: the merges folded over its bytes.
    ``table`` is the bound literal of ``ranks``.

    The state is the parts: the id of each and the rank of it joined with the
    next one (null: no token). A step puts the leftmost pair of the lowest rank
    in the place of its first part, under the id that is that rank, drops the
    second part and looks up the two new pairs."""
    chars = F.split(F.decode(word, "ISO-8859-1"), "")
    bytes_ = F.transform(chars, lambda c: F.element_at(table["bytes"], F.ascii(c) + 1))
    steps = F.sequence(F.lit(2), F.greatest(F.octet_length(word), F.lit(2)))

    def part(p: Column, following: Column) -> Column:
        return F.struct(p.alias("id"), ranks.rank(table, p, following).alias("rank"))

    def join(state: Column, least: Column, at: Column) -> Column:
        """``at``: index from 0 of the pair's first part."""
        return F.filter(F.transform(state, lambda x, i: F.when(
            i == at, part(least, F.get(state, at + 2)["id"])).when(
            i == at - 1, part(x["id"], least)).otherwise(x)), lambda _, i: i != at + 1)

    def step(state: Column, _: Column) -> Column:
        return bind(F.transform(state, lambda x: x["rank"]), lambda pairs: bind(
            F.array_min(pairs), lambda least: F.when(least.isNull(), state).otherwise(bind(
                F.array_position(pairs, least).cast("int") - 1,
                lambda at: join(state, least, at)))))

    return bind(bytes_, lambda s: F.aggregate(
        steps, F.transform(s, lambda p, i: part(p, F.get(s, i + 1))), step,
        lambda done: F.transform(done, lambda x: x["id"])))


# --- words -----------------------------------------------------------------

class Splitter:
    """Words of a text by the pattern, with the text first cut before every
    space. No word spans such a place unless white space meets white space
    there (two in a row decide what a run of them is), so a stretch that
    occurs again need not be cut again."""

    def __init__(self, pattern: str):
        self.words = regex.compile(pattern).findall
        self.doubled = regex.compile(r"\s\s").search

    def stretches(self, text: str) -> list[str] | None:
        """What stands before the first space and after each space; None if
        the text must be cut as a whole."""
        return None if self.doubled(text) else text.split(" ")

    def after_space(self, stretch: str) -> list[str]:
        return self.words(" " + stretch)


def word_counts(docs: DataFrame, pattern: str) -> DataFrame:
    """(word, n) of every distinct word of all texts, longer ones left out."""
    schema = arrow_schema("word binary, n long")

    def run(batches):
        split = Splitter(pattern)
        counts: Counter[str] = Counter()   # words
        again: Counter[str] = Counter()    # stretches after a space

        def out():
            for stretch, n in again.items():
                for w in split.after_space(stretch):
                    counts[w] += n
            rows = [(w.encode("utf-8", "surrogatepass"), n) for w, n in counts.items()]
            rows = [r for r in rows if len(r[0]) <= COMMON_BYTES]
            counts.clear()
            again.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                               pa.array([r[1] for r in rows], pa.int64())],
                                              schema=schema)

        for part in slices(batches):
            for text in texts_of(part):
                own = split.stretches(text)
                if own is None:
                    counts.update(split.words(text))
                else:
                    counts.update(split.words(own[0]))
                    again.update(own[1:])
            if len(counts) + len(again) > COUNTED:
                yield out()
        yield out()

    made = docs.select("text").mapInArrow(run, "word binary, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def common_words(docs: DataFrame, pattern: str, ranks: RankMap) -> dict[str, bytes]:
    """The most frequent words with their ids as bytes: all words with at
    least the smallest count that no more than COMMON words reach."""
    counts = stored(word_counts(docs, pattern), "bpe-words")
    capped = F.least("n", F.lit(10_000)).alias("n")  # 10,000 rows at most
    held, least = 0, None
    for r in sorted(counts.groupBy(capped).agg(F.count(F.lit(1)).alias("k")).collect(),
                    key=lambda r: -r.n):
        held += r.k
        if held > COMMON:
            break
        least = r.n
    if least is None:
        discard(counts)
        return {}
    rows = counts.where(F.col("n") >= least).select("word", bind(
        ranks.literal(), lambda t: fold(ranks, t, F.col("word"))).alias("ids")).toArrow()
    discard(counts)
    ids = rows["ids"].combine_chunks()
    flat = ids.values.to_numpy().astype("<i4").tobytes()
    ends = (np.asarray(ids.offsets) * 4).tolist()
    return {w.decode("utf-8", "surrogatepass"): flat[a:b]
            for w, a, b in zip(rows["word"].to_pylist(), ends, ends[1:], strict=False)}


# --- documents -------------------------------------------------------------

def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """All columns of ``docs`` but ``text``, then ``marked`` (ids, -k - 1 for
    the k-th word of ``rare``), ``rare`` (distinct words) and ``rare_ids``."""
    merges = RankMap(ranks)
    shared = docs.sparkSession.sparkContext.broadcast(common_words(docs, pattern, merges))

    split = Splitter(pattern)
    memo: dict[str, bytes] = {}  # of a task: ids of stretches whose words are all known

    def mark(part: pa.RecordBatch) -> dict:
        known = shared.value.get
        marked, rare = [], []

        def ids_of(words: list[str], own: dict[str, bytes]) -> tuple[bytes, bool]:
            """Ids of words, and whether all are known."""
            out = list(map(known, words))
            if None not in out:
                return b"".join(out), True
            for k, w in enumerate(words):
                if out[k] is None:
                    out[k] = own.setdefault(w, (-len(own) - 1).to_bytes(4, "little", signed=True))
            return b"".join(out), False

        if len(memo) > KNOWN:
            memo.clear()
        for text in texts_of(part):
            own: dict[str, bytes] = {}
            stretches = split.stretches(text)
            if stretches is None:
                marked.append(ids_of(split.words(text), own)[0])
            else:
                first = ids_of(split.words(stretches[0]), own)[0]
                out = list(map(memo.get, stretches))
                for k, stretch in enumerate(stretches):
                    if k and out[k] is None:
                        out[k], whole = ids_of(split.after_space(stretch), own)
                        if whole:
                            memo[stretch] = out[k]
                out[0] = first
                marked.append(b"".join(out))
            rare.append([w.encode("utf-8", "surrogatepass") for w in own])
        return {"marked": marked, "rare": rare}

    rows = map_rows(docs, mark, "marked binary, rare array<binary>")
    return rows.withColumn("rare_ids", bind(merges.literal(), lambda t: F.transform(
        "rare", lambda w: fold(merges, t, w))))


def filled(marked: bytes, rare: list[list[int]]) -> np.ndarray:
    """The ids with those of the rare words put in."""
    ids = np.frombuffer(marked, "<i4")
    if not rare:
        return ids
    at = np.flatnonzero(ids < 0)
    which = -ids[at] - 1
    size = np.array([len(r) for r in rare])
    start = np.cumsum(size) - size
    flat = np.concatenate([np.asarray(r, np.int32) for r in rare])
    reps = np.ones(len(ids), np.int64)
    reps[at] = size[which]
    out = np.repeat(ids, reps)
    place = (np.cumsum(reps) - reps)[at]
    n = size[which]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(place, n) + inner] = flat[np.repeat(start[which], n) + inner]
    return out


def op4_byte_bpe(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # written first: a task that marks and digests at once needs two Python workers
    encoded = stored(encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
                     .select("doc_id", "marked", "rare_ids"), "bpe-ids", "zstd")
    schema = arrow_schema("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    pieces = np.empty(max(ranks.values()) + 1, object)
    for token, rank in ranks.items():
        pieces[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(list(pieces))  # the vocabulary

    def digests(batches):
        token = shared.value
        number = [str(k) for k in range(len(token))]
        for part in slices(batches, "marked", 8_000_000):
            out = []
            for r in part.to_pylist():
                ids = filled(r["marked"], r["rare_ids"]).tolist()
                text = " ".join(map(number.__getitem__, ids)).encode()
                back = b"".join(map(token.__getitem__, ids))
                out.append({"doc_id": r["doc_id"], "n_tokens": len(ids),
                            "ids_sha256": hashlib.sha256(text).hexdigest(),
                            "decoded_sha256": hashlib.sha256(back).hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return encoded.mapInArrow(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
