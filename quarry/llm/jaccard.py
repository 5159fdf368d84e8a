"""Near duplicates: Jaccard self-join on word n-grams by prefix filtering.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Two
documents link when their sets' Jaccard similarity is 0.75 or more; the result
names the connected component of every document. Documents with equal sets
form one class, and the join is between classes.

Rare first: all sets are ordered by (count of the shingle's bucket in a sketch
over all documents, hash), one order for the whole corpus, so the filters are
exact whatever the sketch says; it only decides how few candidates there are.
Of a set of n shingles the first n - ceil(0.75 n) + SHARED go into the join:
two sets that link share SHARED of those (or as many as they must have in
common at all). Pairs also pass the length and the positional filter where
they meet, and the suffix filter (cell counts of both sets) before their texts
are fetched; each pair is verified once, on the whole sets.

A shingle that thousands of classes hold would give all their pairs. So the
join runs in two steps: first every class meets the least class of each of its
lists, and the verified links make components; then only pairs of classes in
different components are formed. Pairs left out are inside one component
already, so no component is lost. Lists of very common shingles are salted.

Edge cases: null or empty texts, and texts without words, have an empty set
and link with nothing; texts of fewer than five words have one shingle, the
whole sequence; repeated rows are copies of each other; a null id never names
a component while the component holds an id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, discard, map_rows, slices, stored, texts_of
from quarry.llm.components import components

WORDS = 5
SHARED = 3             # prefix shingles that a pair must share
SKETCH_BITS = 22       # the sketch has 2 ** SKETCH_BITS counters
CHUNKS = 16            # pieces in which sketches are summed
SALT_ROWS = 4096       # sets per salt of a common shingle
BLOOM_BITS = 1 << 24   # bits of the filter on classes whose texts are fetched
CELLS = 32             # cells of the suffix filter

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lowered; blanks are x20 and x09-x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_sets(words: list[list[bytes]]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, given as words."""
    sizes = [len(w) for w in words]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in words for w in ws),
                         np.uint64, sum(sizes))
    rolled = hashes[:max(0, len(hashes) - WORDS + 1)].copy()
    for k in range(1, WORDS):
        rolled = rolled * _MULTIPLIER + hashes[k:k + len(rolled)]
    rolled = _mix(rolled)
    out, at = [], 0
    for n, ws in zip(sizes, words, strict=True):
        if n >= WORDS:
            out.append(np.unique(rolled[at:at + n - WORDS + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(ws), seed=n)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def class_key(shingles: np.ndarray, salt: int) -> bytes:
    """16 bytes that name a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16,
                           salt=salt.to_bytes(8, "little")).digest()


def _class_id(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def least_overlap(a: Column, b: Column) -> Column:
    """Shingles that sets of sizes a and b share at least when they link:
    100 * i >= 75 * (a + b - i)."""
    return F.ceil(3 * (a + b) / 7)


MEMBERS = ("doc_id long, n long, c long, key binary, cells array<int>, chunk int, "
           "counts binary")


def members(docs: DataFrame, salt: int) -> DataFrame:
    """Set size and class of every document, and each task's sketch."""
    schema = arrow_schema(MEMBERS)

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        press = zstandard.ZstdCompressor(level=1)
        for part in slices(batches):
            sets = shingle_sets([words_of(t) for t in texts_of(part)])
            every = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
            sketch += np.bincount(every.astype(np.int64), minlength=len(sketch)).astype(np.uint32)
            keys = [class_key(s, salt) for s in sets]
            cells = [np.bincount((s & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
                     .astype(np.int32) for s in sets]
            none = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_class_id(k) for k in keys], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(cells, pa.list_(pa.int32())), none.cast(pa.int32()), none.cast(pa.binary())],
                schema=schema)
        for k, counts in enumerate(np.split(sketch, CHUNKS)):
            if counts.any():
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": k, "counts": press.compress(counts.tobytes())}], schema=schema)

    return stored(docs.select("doc_id", "text").mapInArrow(run, MEMBERS), "jaccard-members")


def _counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint32)


def _add_sketches(batches):
    """Sum of the sketch chunks of a partition; holds one sketch at most."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(),
                          strict=True):
            total[k] = total[k] + _counts(raw) if k in total else _counts(raw)
    press = zstandard.ZstdCompressor(level=1)
    for k, counts in total.items():
        yield pa.RecordBatch.from_pydict({
            "chunk": pa.array([k], pa.int32()),
            "counts": pa.array([press.compress(counts.tobytes())], pa.binary())})


def sketch_of(table: DataFrame) -> np.ndarray:
    """The corpus sketch: 2 ** SKETCH_BITS counters, summed in two levels."""
    parts = table.where("chunk is not null").select("chunk", "counts")
    parts = parts.mapInArrow(_add_sketches, parts.schema)  # where they lie
    done = parts.repartition("chunk").mapInArrow(_add_sketches, parts.schema)
    size = (1 << SKETCH_BITS) // CHUNKS
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in done.collect():  # CHUNKS rows
        sketch[r.chunk * size:(r.chunk + 1) * size] = _counts(r.counts)
    return sketch


def prefix_length(n: int) -> int:
    return min(n, n - -(-3 * n // 4) + SHARED)


ROWS = "s long, salt int, c long, n int, pos int"


def prefixes(docs: DataFrame, sketch: np.ndarray, salt: int) -> DataFrame:
    """The rarest shingles of every class, with size and position. A task
    emits a class once; copies in other tasks are dropped after the shuffle."""
    schema = arrow_schema(ROWS)
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # 2 ** SKETCH_BITS counters

    def run(batches):
        counts_of, seen = shared.value, set()
        for part in slices(batches):
            s, salts, c, n, pos = [], [], [], [], []
            for own in shingle_sets([words_of(t) for t in texts_of(part)]):
                name = _class_id(class_key(own, salt)) if len(own) else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                count = counts_of[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                first = np.argsort(count, kind="stable")[:prefix_length(len(own))]
                s.append(own[first].view(np.int64))
                parts = count[first] // SALT_ROWS  # 0: not salted; else salts from 1
                salts.append(np.where(parts, 1 + zlib.crc32(own[:4].tobytes()) % (parts + 1), 0)
                             .astype(np.int32))
                c.append(np.full(len(first), name, np.int64))
                n.append(np.full(len(first), len(own), np.int32))
                pos.append(np.arange(len(first), dtype=np.int32))
            if s:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (s, salts, c, n, pos)], schema=schema)

    return docs.select("text").mapInArrow(run, ROWS)


def shared_lists(rows: DataFrame) -> DataFrame:
    """Prefix rows of shingles that two classes or more hold, with the least
    class of their list (``least``: c, n, pos). One shuffle, read twice."""
    dealt = rows.repartition("s", "salt")
    lists = dealt.groupBy("s", "salt").agg(
        F.min(F.struct("c", "n", "pos")).alias("least"), F.max("c").alias("most"))
    lists = lists.where((F.col("least.c") != F.col("most")) | (F.col("salt") > 0))
    held = dealt.join(lists.drop("most"), ["s", "salt"]).dropDuplicates(["s", "salt", "c"])
    return stored(held, "jaccard-lists")


def candidates(pairs: DataFrame, all_meetings: bool) -> DataFrame:
    """(x, y) of meetings (x, nx, px, y, ny, py) that pass the length and the
    positional filter often enough; one row per pair. With all meetings of
    every pair at hand: two sets have in common their meetings up to the last
    one, and after it no more than either has left; pairs that this rules out
    go as well."""
    nx, ny = F.col("nx"), F.col("ny")
    need = least_overlap(nx, ny)
    met = pairs.where((4 * F.least(nx, ny) >= 3 * F.greatest(nx, ny))
                      & (F.least(nx - F.col("px"), ny - F.col("py")) >= need - (SHARED - 1)))
    ordered = F.col("x") < F.col("y")
    return (met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"),
                       F.when(ordered, nx).otherwise(ny).alias("nx"),
                       F.when(ordered, ny).otherwise(nx).alias("ny"),
                       F.when(ordered, F.col("px")).otherwise(F.col("py")).alias("px"),
                       F.when(ordered, F.col("py")).otherwise(F.col("px")).alias("py"))
            .groupBy("x", "y", "nx", "ny").agg(F.count(F.lit(1)).alias("met"),
                                               F.max("px").alias("px"), F.max("py").alias("py"))
            .where(F.col("met") >= F.least(F.lit(SHARED), need))
            .where(F.lit(not all_meetings) | (
                F.col("met") + F.least(nx - F.col("px"), ny - F.col("py")) - 1 >= need))
            .select("x", "y", "nx", "ny"))


def meetings_with_least(lists: DataFrame) -> DataFrame:
    """Every class with the least class of its list, and the least classes of
    the salts of one shingle with the least of those."""
    own = lists.where(F.col("c") != F.col("least.c")).select(
        F.col("c").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"),
        F.col("least.c").alias("y"), F.col("least.n").alias("ny"), F.col("least.pos").alias("py"))
    heads = lists.where(F.col("c") == F.col("least.c")).select("s", "least")
    salted = lists.where("salt > 0").select("s").distinct()
    heads = heads.join(salted, "s", "left_semi")
    top = heads.groupBy("s").agg(F.min("least").alias("top"))
    across = heads.join(top, "s").where(F.col("least.c") != F.col("top.c")).select(
        F.col("least.c").alias("x"), F.col("least.n").alias("nx"), F.col("least.pos").alias("px"),
        F.col("top.c").alias("y"), F.col("top.n").alias("ny"), F.col("top.pos").alias("py"))
    return own.unionByName(across)


def meetings_across(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of one list whose classes lie in different components: rows
    outside the list's largest component, against all its rows."""
    named = (lists.select("s", "c", "n", "pos").join(roots, F.col("c") == F.col("node"), "left")
             .select("s", "c", "n", "pos", F.coalesce("root", "c").alias("root")))
    sizes = named.groupBy("s", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = (sizes.groupBy("s").agg(F.max(F.struct("k", "root")).alias("top"),
                                      F.count(F.lit(1)).alias("parts"))
               .where("parts > 1").select("s", F.col("top.root").alias("main")))
    mixed = stored(named.join(largest, "s"), "jaccard-mixed")
    few = mixed.where("root <> main").select(
        "s", F.col("c").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"),
        F.col("root").alias("rx"))
    every = mixed.select("s", F.col("c").alias("y"), F.col("n").alias("ny"),
                         F.col("pos").alias("py"), F.col("root").alias("ry"), "main")
    return (few.join(every, "s").where((F.col("rx") != F.col("ry"))
                                       & ((F.col("ry") == F.col("main")) | (F.col("x") < F.col("y"))))
            .drop("rx", "ry", "main", "s"))


def meetings_of_all(lists: DataFrame) -> DataFrame:
    """Every pair of classes of one shingle. The salts of a shingle are its
    blocks; pairs of blocks meet under keys of their own, so that no key holds
    more than two blocks."""
    heads = lists.select("s", "salt").distinct()
    salts = heads.groupBy("s").agg(F.collect_set("salt").alias("salts"))
    dealt = lists.select("s", "salt", "c", "n", "pos").join(heads.join(salts, "s"), ["s", "salt"])
    left = dealt.select("s", F.col("salt").alias("i"),
                        F.explode(F.filter("salts", lambda j: j >= F.col("salt"))).alias("j"),
                        F.col("c").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"))
    right = dealt.select("s", F.explode(F.filter("salts", lambda i: i <= F.col("salt"))).alias("i"),
                         F.col("salt").alias("j"),
                         F.col("c").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"))
    return (left.join(right, ["s", "i", "j"])
            .where((F.col("i") < F.col("j")) | (F.col("x") < F.col("y"))).drop("s", "i", "j"))


SHIFTS = (0, 20, 40)   # a class id is a digest: any bits of it serve the filter


def _bits(c: Column) -> Column:
    """The positions of a class in the Bloom filter."""
    return F.array(*[F.shiftrightunsigned(c, k).bitwiseAND(F.lit(BLOOM_BITS - 1)) for k in SHIFTS])


def _in_bloom(bloom: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whether class ids pass the filter."""
    at = np.stack([c.view(np.uint64) >> np.uint64(k) & np.uint64(BLOOM_BITS - 1) for k in SHIFTS])
    return ((bloom[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32))
            & np.uint32(1)).all(axis=0)


def bodies(docs: DataFrame, lists: DataFrame, salt: int) -> DataFrame:
    """(c, body): compressed words of the classes that share enough prefix
    shingles with others to be in a pair. The classes pass a Bloom filter of
    BLOOM_BITS bits first (a wrong yes only costs space)."""
    enough = F.least(F.lit(SHARED), F.ceil(3 * F.col("n") / 4))
    wanted = stored(lists.groupBy("c", "n").agg(F.count(F.lit(1)).alias("k"))
                    .where(F.col("k") >= enough).select("c"), "jaccard-wanted")
    words = (wanted.select(F.explode(_bits(F.col("c"))).alias("bit"))
             .groupBy(F.shiftright("bit", 5).alias("at"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("on")))
    bloom = np.zeros(BLOOM_BITS // 32, np.uint32)
    found = words.toArrow()  # BLOOM_BITS / 32 rows at most
    bloom[found["at"].to_numpy()] = found["on"].to_numpy().astype(np.uint32)

    shared = docs.sparkSession.sparkContext.broadcast(bloom)  # BLOOM_BITS bits

    def run(batches):
        # one Python step makes and filters: two would need twice the workers
        press = zstandard.ZstdCompressor(level=1)
        for part in slices(batches):
            words = [w for w in (words_of(t) for t in texts_of(part)) if w]
            c = np.array([_class_id(class_key(s, salt)) for s in shingle_sets(words)], np.int64)
            on = np.flatnonzero(_in_bloom(shared.value, c)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[on]), pa.array([press.compress(b" ".join(words[k])) for k in on], pa.binary())],
                names=["c", "body"])

    kept = docs.select("text").mapInArrow(run, "c long, body binary")
    chosen = kept.join(wanted, "c", "left_semi")
    out = stored(chosen.groupBy("c").agg(F.first("body").alias("body")), "jaccard-bodies")
    discard(wanted)
    return out


def _verify(batches):
    """Pairs whose whole sets link; y's set is kept while its rows follow."""
    press, last, cached = zstandard.ZstdDecompressor(), None, None
    for batch in slices(batches, "bx"):
        xs = batch.column("x").to_pylist()
        ys = batch.column("y").to_pylist()
        xsets = shingle_sets([press.decompress(b).split() for b in batch.column("bx").to_pylist()])
        on = []
        for k, (y, a) in enumerate(zip(ys, xsets, strict=True)):
            if y != last:
                last = y
                cached = shingle_sets([press.decompress(batch.column("by")[k].as_py()).split()])[0]
            both = len(np.intersect1d(a, cached, assume_unique=True))
            on.append(100 * both >= 75 * (len(a) + len(cached) - both))
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([x for x, ok in zip(xs, on, strict=True) if ok], pa.int64()),
            "b": pa.array([y for y, ok in zip(ys, on, strict=True) if ok], pa.int64())})


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among candidate pairs: the suffix filter on cell counts,
    then the whole sets, once per pair."""
    def side(name: str) -> DataFrame:
        return classes.select(F.col("c").alias(name), F.col("cells").alias(f"cells_{name}"))
    gap = F.aggregate(F.zip_with("cells_x", "cells_y", lambda p, q: F.abs(p - q)),
                      F.lit(0), lambda t, d: t + d)
    allowed = F.col("nx") + F.col("ny") - 2 * least_overlap(F.col("nx"), F.col("ny"))
    left = pairs.join(side("x"), "x").join(side("y"), "y").where(gap <= allowed).select("x", "y")
    full = (left.join(texts.select(F.col("c").alias("x"), F.col("body").alias("bx")), "x")
            .join(texts.select(F.col("c").alias("y"), F.col("body").alias("by")), "y"))
    return stored(full.mapInArrow(_verify, "a long, b long"), "jaccard-verified")


def collision(rows: DataFrame) -> bool:
    """Whether two different sets share a 64-bit class id (then: other salt)."""
    twice = rows.groupBy("c").agg(F.min("key").alias("p"), F.max("key").alias("q")).where("p <> q")
    return not twice.isEmpty()


def linked_pairs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The join itself: all links (a, b) between classes, a < b, each once,
    and the membership (doc_id, n, c) of every document; c is null for an
    empty set. Documents of one class link as well. Unlike near_duplicates it
    forms every pair of a group of near copies: the output has them all."""
    salt = 0
    while collision((table := members(docs, salt)).where("n > 0")):
        discard(table)
        salt += 1
    own = table.where("chunk is null").select("doc_id", "n", F.when(F.col("n") > 0, F.col("c")).alias("c"))
    classes = table.where("n > 0").groupBy("c").agg(F.first("cells").alias("cells"))
    lists = shared_lists(prefixes(docs, sketch_of(table), salt))
    texts = bodies(docs, lists, salt)
    pairs = stored(candidates(meetings_of_all(lists), True), "jaccard-pairs")
    links = verified(pairs, classes, texts)
    discard(pairs, lists, texts)
    return links, own


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, n, c, root) of every document: set size, class, and the least
    class of its component; c and root are null for an empty set. Also the
    salt of the class ids."""
    salt = 0
    while collision((table := members(docs, salt)).where("n > 0")):
        discard(table)
        salt += 1
    own = table.where("chunk is null").select("doc_id", "n", F.when(F.col("n") > 0, F.col("c")).alias("c"))
    classes = table.where("n > 0").groupBy("c").agg(F.first("cells").alias("cells"))
    lists = shared_lists(prefixes(docs, sketch_of(table), salt))
    texts = bodies(docs, lists, salt)

    pairs = stored(candidates(meetings_with_least(lists), False), "jaccard-pairs")
    links = verified(pairs, classes, texts)
    discard(pairs)
    pairs = stored(candidates(
        meetings_across(lists, components(links)), True), "jaccard-pairs")
    more = verified(pairs, classes, texts)
    discard(pairs, lists, texts)
    roots = components(links.union(more))
    named = own.join(roots, F.col("c") == F.col("node"), "left").select(
        "doc_id", "n", "c", F.coalesce("root", "c").alias("root"))
    return stored(named, "jaccard-roots"), salt


def op7_ngram_jaccard(docs: DataFrame) -> DataFrame:
    rows, _ = near_duplicates(docs)
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        .alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of every component the document with the smallest id,
    one row; documents with an empty set all stay."""
    columns = docs.columns
    own = {c: f"_own{c}" for c in columns if c[0] == "_"}
    docs = docs.withColumnsRenamed(own)  # names that may clash stand aside
    rows, salt = near_duplicates(docs)
    kept = (rows.where("root is not null").groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "c")).alias("k"))
            .select(F.col("k.c").alias("_kept"), F.col("k.doc_id").alias("_id")))

    def name(part: pa.RecordBatch) -> dict:
        sets = shingle_sets([words_of(t) for t in texts_of(part)])
        return {"_class": [_class_id(class_key(s, salt)) if len(s) else None for s in sets]}

    named = map_rows(docs, name, "_class long", keep_text=True)
    chosen = named.join(kept, (F.col("_class") == F.col("_kept"))
                        & F.col("doc_id").eqNullSafe(F.col("_id"))).dropDuplicates(["_class"])
    kept = chosen.select(*docs.columns).unionByName(
        named.where("_class is null").select(*docs.columns))
    return kept.withColumnsRenamed({v: k for k, v in own.items()})
