"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents become pieces of at most ``CAPACITY`` tokens; a full piece is a
sequence of its own. The rest is dealt into shards of about ``SHARD`` pieces.
Several islands search each shard: an individual is a list of bins, crossover
takes whole well-filled bins of one parent into the other, drops the bins that
hold a piece twice and best-fits the displaced pieces; mutation dissolves the
emptiest bins. After every epoch the best individual of each island moves to
the next island. Bins that are still not well filled are dealt anew, level by
level, until one shard is left. After a level that settles less than a quarter
of its pieces the shards become twice as large, up to ``GROWN`` times, and then
the fill that settles a bin falls (``FILLS``, down to none): pieces that can't
be combined to full sequences settle as they were packed best.

Edge cases: a null or empty text is the single end token; repeated rows are
packed once each; null ids are kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import bisect
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, slices, stored, texts_of

CAPACITY = 4096
END = 1                # id after every document
SHARD = 1500           # pieces of a shard, about
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
CHILDREN = 8           # per island and epoch
FILLS = (0.999, 0.99, 0.9, 0.5, 0.0)  # fills at which a bin is settled, one after the other
SETTLES = 0.25         # share of its pieces that a level should settle
GROWN = 4              # times SHARD that a shard has at most
MEMO_WORDS = 500_000   # encoded words a worker remembers, about
TEXT = 6_000_000       # characters of text encoded at a time
# a word of Latin letters below U+0250, but for U+0130
LETTERS = "^[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"


def bytes_of(words: pa.Array) -> list[bytes]:
    """The values of a string array."""
    _, ends, data = words.buffers()
    at = np.frombuffer(ends, np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def parts(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(core, tail) of words: the tail is a run of commas and stops after a
    letter. ASCII words are lowered, but for marks such as <|endoftext|>."""
    plain = pc.and_not(pc.string_is_ascii(words), pc.match_substring(words, "<"))
    words = pc.if_else(plain, pc.ascii_lower(words), words)
    core = pc.if_else(pc.match_substring_regex(words, "[A-Za-z][,.]+$"), pc.ascii_rtrim(words, ",."), words)
    size = pc.subtract(pc.binary_length(words), pc.binary_length(core)).to_numpy()
    tail = [b""] * len(words)
    raw = bytes_of(words)
    for k in np.flatnonzero(size).tolist():
        tail[k] = raw[k][-size[k]:]
    return core, pa.array(tail, pa.binary()).view(pa.string())


def taken(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat``, which lie there one after the other with their
    ``size``, in the order ``which``; and where each ends."""
    n = size[which]
    ends = np.cumsum(n)
    shift = (np.cumsum(size) - size)[which] - ends + n
    return flat[np.repeat(shift, n) + np.arange(ends[-1])], ends


class Encoder:
    """Ids of whole texts, as little-endian bytes, by encoding each distinct
    word once. The tokenizer's normaliser and pattern never look across ASCII
    white space, nor from a letter to the comma or stop after it, so a text's
    ids are those of its words in a row. Texts are cut and their words numbered
    by Arrow; Python sees the distinct words of a slice only."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the memo before; what is met again moves on
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def encode_line(self, some: list[bytes]) -> list[bytes]:
        """Encode words of Latin letters as one line; each is one word of the
        tokenizer, so its last id carries the end mark. Gives back the words
        if the marks don't match them one to one."""
        e = self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
        ids = np.array(e[0].ids, "<u4")
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(ends) != len(some):
            return some
        raw = ids.tobytes()
        self.memo.update(zip(some, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        return []

    def learn(self, words: list[bytes]) -> None:
        """Put the ids of words into the memo."""
        text = pa.array(words, pa.binary()).view(pa.string())
        letters = pc.match_substring_regex(text, LETTERS).to_numpy(zero_copy_only=False).tolist()
        plain = [w for w, yes in zip(words, letters, strict=True) if yes]
        other = [w for w, yes in zip(words, letters, strict=True) if not yes]
        for at in range(0, len(plain), 1000):
            other += self.encode_line(plain[at:at + 1000])
        for at in range(0, len(other), 5000):
            some = other[at:at + 5000]
            found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in some],
                                                     add_special_tokens=False)
            self.memo.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(some, found, strict=True))

    def ids_of(self, words: pa.Array) -> list[bytes]:
        """Ids of distinct words."""
        own = bytes_of(words)
        if len(self.memo) > MEMO_WORDS // 2:
            self.memo, self.older = {}, self.memo
        found = list(map(self.memo.get, own))
        if None in found:
            new = [w for w, ids in zip(own, found, strict=True) if ids is None]
            again = list(map(self.older.get, new))
            self.memo.update((w, ids) for w, ids in zip(new, again, strict=True) if ids is not None)
            self.learn([w for w, ids in zip(new, again, strict=True) if ids is None])
            found = list(map(self.memo.__getitem__, own))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        raw = pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.binary())
        split = pc.ascii_split_whitespace(raw.view(pa.string()))  # bytes alone are looked at
        numbered = split.flatten().dictionary_encode()
        core, tail = parts(numbered.dictionary)
        both = pa.concat_arrays([core, tail]).dictionary_encode()
        ids = self.ids_of(both.dictionary)
        n_words, place = len(core), both.indices.to_numpy()
        # the ids of every distinct word, and of the end as one more
        pair = np.append(np.stack([place[:n_words], place[n_words:]], 1).ravel(), len(ids))
        ids = [*ids, np.array([END], "<u4").tobytes()]
        words, upto = taken(np.frombuffer(b"".join(ids), "<u4"),
                            np.fromiter(map(len, ids), np.int64, len(ids)) // 4, pair)
        size = np.diff(np.append(upto[1:-1:2], upto[-1]), prepend=0)
        count = split.offsets.to_numpy()[1:]                  # words before the end of each text
        which = np.insert(numbered.indices.to_numpy(), count, n_words)
        out, behind = taken(words, size, which)
        ends = (4 * behind[count + np.arange(len(count))]).tolist()
        raw = out.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def encoder(path: str) -> Encoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


class Kept:
    """The encoder of a worker, made when first asked for. Broadcast, it is
    kept from task to task and let go with the broadcast, so that other stages
    in the same worker don't carry its memo."""

    def __init__(self, path: str):
        self.path, self.made = path, None

    def get(self) -> Encoder:
        if self.made is None:
            self.made = encoder(self.path)
        return self.made


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The pieces of every document, each with a ``pid`` of its own; written
    once, so that the numbers hold."""
    arrow = arrow_schema(PIECES)
    shared = docs.sparkSession.sparkContext.broadcast(Kept(tokenizer_path))

    def run(batches):
        enc = shared.value.get()
        for part in slices(batches, most=TEXT):
            out = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(texts_of(part)),
                                   strict=True):
                for k, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
                    own = ids[at:at + 4 * CAPACITY]
                    out.append((doc_id, k, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)],
                schema=arrow)

    made = docs.select("doc_id", "text").mapInArrow(run, PIECES)
    return stored(made.withColumn("pid", F.monotonically_increasing_id()), "pieces")


class Bins:
    """Bins of piece numbers with their fill, and the free room in order."""

    def __init__(self, lengths: list[int]):
        self.lengths, self.bins, self.fill = lengths, [], []

    def add(self, bin_: list[int]) -> None:
        self.bins.append(bin_)
        self.fill.append(sum(self.lengths[i] for i in bin_))

    def best_fit(self, items: list[int]) -> None:
        """Put the items, longest first, where they leave the least room."""
        room = sorted((CAPACITY - f, b) for b, f in enumerate(self.fill) if f < CAPACITY)
        for i in sorted(items, key=lambda i: -self.lengths[i]):
            size = self.lengths[i]
            at = bisect.bisect_left(room, (size, -1))
            if at < len(room):
                free, b = room.pop(at)
                self.bins[b].append(i)
                self.fill[b] += size
            else:
                free, b = CAPACITY, len(self.bins)
                self.bins.append([i])
                self.fill.append(size)
            if free > size:
                bisect.insort(room, (free - size, b))

    def fitness(self) -> tuple[float, float]:
        """Fewer bins, then fuller ones (mean squared fill)."""
        return -len(self.bins), sum(f * f for f in self.fill)

    def copy_without(self, dropped: set[int]) -> "Bins":
        out = Bins(self.lengths)
        for b, bin_ in enumerate(self.bins):
            if b not in dropped:
                out.bins.append(list(bin_))
                out.fill.append(self.fill[b])
        return out


def crossover(a: Bins, b: Bins, rng: random.Random) -> Bins:
    """``a`` with some of the fullest bins of ``b`` put in whole."""
    best = sorted(range(len(b.bins)), key=lambda k: -b.fill[k])[:max(1, len(b.bins) // 2)]
    chosen = rng.sample(best, max(1, len(best) // 4))
    taken = {i for k in chosen for i in b.bins[k]}
    hit = {k for k, bin_ in enumerate(a.bins) if not taken.isdisjoint(bin_)}
    child = a.copy_without(hit)
    for k in chosen:
        child.add(list(b.bins[k]))
    child.best_fit([i for k in hit for i in a.bins[k] if i not in taken])
    return child


def mutate(a: Bins, rng: random.Random) -> Bins:
    """The emptiest bin and some others dissolved and best-fitted anew."""
    worst = min(range(len(a.bins)), key=lambda k: a.fill[k])
    drop = {worst, *rng.sample(range(len(a.bins)), min(len(a.bins), 1 + len(a.bins) // 20))}
    child = a.copy_without(drop)
    child.best_fit([i for k in drop for i in a.bins[k]])
    return child


def evolve(lengths: list[int], guests: list[list[list[int]]], seed: int) -> list[list[int]]:
    """One epoch of one island; the best individual found. ``guests`` are the
    island's own best and the elite that came in (none in the first epoch)."""
    rng = random.Random(seed)
    population: list[Bins] = []
    for bins in guests:
        one = Bins(lengths)
        for b in bins:
            one.add(list(b))
        population.append(one)
    bound = -(-sum(lengths) // CAPACITY)
    while len(population) < POPULATION:
        one = Bins(lengths)
        items = list(range(len(lengths)))
        if population:  # the first is plain best-fit decreasing, the others start astray
            rng.shuffle(items)
            some = len(items) // 5
            for i in items[:some]:
                one.add([i])
            items = items[some:]
        one.best_fit(items)
        population.append(one)
    for _ in range(CHILDREN):
        population.sort(key=Bins.fitness, reverse=True)
        if len(population[0].bins) <= bound:
            break
        a, b = rng.sample(population[:POPULATION], 2)
        population.append(mutate(crossover(a, b, rng), rng))
    return max(population, key=Bins.fitness).bins


ISLAND = "shard long, island int, pids array<long>, lengths array<int>, best array<array<int>>"


def pack_shards(rows: DataFrame, n_shards: int, level: int) -> DataFrame:
    """(pid, sequence_id, offset, fill) of rows (pid, length): islands with
    elite migration over each of ``n_shards`` shards. A sequence is named by
    the smallest pid in it."""
    shard = F.pmod(F.xxhash64("pid", F.lit(level)), F.lit(n_shards))
    state = (rows.groupBy(shard.alias("shard"))
             .agg(F.sort_array(F.collect_list(F.struct("pid", F.col("length").cast("int")
                                                       .alias("length")))).alias("all"))
             .select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                     F.col("all.pid").alias("pids"), F.col("all.length").alias("lengths"))
             .repartition("shard", "island"))

    schema = arrow_schema(ISLAND)

    def epoch(number: int):
        def run(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    guests = [g for g in (r.get("best"), r.get("elite")) if g]
                    best = evolve(r["lengths"], guests, r["shard"] * 1009 + r["island"] * 31 + number)
                    yield pa.RecordBatch.from_pylist(
                        [{k: r[k] for k in ("shard", "island", "pids", "lengths")} | {"best": best}],
                        schema=schema)
        return run

    for number in range(EPOCHS):
        state = stored(state.mapInArrow(epoch(number), ISLAND), f"islands-{level}-{number}")
        if number < EPOCHS - 1:  # the best of island i moves on to island i + 1
            elite = state.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"),
                                 F.col("best").alias("elite"))
            state = state.join(elite, ["shard", "island"])
    best = (state.groupBy("shard").agg(F.min_by(
        F.struct("pids", "lengths", "best"), F.struct(F.size("best"), "island")).alias("b"))
        .select("b.*"))
    bins = best.select("pids", "lengths", F.explode("best").alias("bin"))
    members = F.transform("bin", lambda i: F.struct(
        F.element_at("pids", i + 1).alias("pid"), F.element_at("lengths", i + 1).alias("length")))
    return (bins.select(members.alias("bin"))
            .withColumn("fill", F.aggregate("bin", F.lit(0), lambda s, m: s + m["length"]))
            .withColumn("sequence_id", F.array_min("bin.pid"))
            .select("sequence_id", "fill", F.explode(F.transform("bin", lambda m, k: F.struct(
                m["pid"].alias("pid"), m["length"].alias("length"),
                F.aggregate(F.slice("bin", 1, k), F.lit(0).cast("long"),
                            lambda s, x: s + x["length"]).alias("offset")))).alias("m"))
            .select("m.pid", "m.length", "sequence_id", "m.offset", "fill"))


def place(rows: DataFrame) -> DataFrame:
    """(pid, sequence_id, offset) of every row (pid, length). Ends: a level
    leaves at most 1 - SETTLES of its pieces, doubles the shards, at most to
    GROWN times, or moves on in FILLS, whose last settles every bin."""
    settled = rows.where(F.col("length") == CAPACITY).select(
        "pid", F.col("pid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_, level = rows.where(F.col("length") < CAPACITY).select("pid", "length"), 0
    n, size, fills = open_.count(), SHARD, list(FILLS)
    while n > 0:
        shards = max(1, round(n / size))
        packed = stored(pack_shards(open_, shards, level), f"packed-{level}")
        done = F.col("fill") >= fills[0] * CAPACITY if shards > 1 else F.lit(True)
        settled = settled.unionByName(packed.where(done).select("pid", "sequence_id", "offset"))
        open_, level = packed.where(~done).select("pid", "length"), level + 1
        before, n = n, open_.count()
        if n > (1 - SETTLES) * before:
            if size < GROWN * SHARD:
                size *= 2
            else:
                fills.pop(0)
    return settled


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Every piece of every document with its sequence and place in it."""
    rows = pieces(docs, tokenizer_path)
    return rows.join(place(rows), "pid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_packing(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
