"""Phrase collocations by stripes.

A task reads its texts as a stream of words and gathers stripes: a prefix keys
a counter of the words that come next, an empty next word standing for the end
of the piece. Every word occurrence starts one prefix of one word, so a merged
stripe has the counts of the two-word phrases that begin with its word (its
entries) and of the word itself (its total). Prefixes of two words are gathered
in a second pass, only where both two-word phrases of three words are frequent
(a Bloom filter of at most ``FILTER_BITS`` bits; a wrong yes only costs space):
a three-word phrase can't be found more often than they. The largest entry of
such a stripe is the most frequent extension of its prefix to the right, and
regrouped by the last two words, to the left.

Stripes are shuffled whole, cut into ``parts`` by the next word, so that the
stripe of a very common prefix is dealt over many tasks, and merged element by
element by a hash aggregate that can spill. What a merged stripe keeps is its
frequent extensions and one counter for all others.

Edge cases: null and empty texts hold no words; a null language counts as
``und``; repeated rows count each time; words of any length; texts of any
length are read in chunks; an empty table gives an empty result; other columns
are ignored; ties of the score go by count, then by the phrase's bytes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, stored

LEAST = 10                # occurrences of a candidate
SHARE = 50                # per cent of a candidate that a longer one covers to drop it
TOP = 2000                # phrases reported per language
PARTS = 8                 # parts of a stripe, at least
SPREAD = 8                # input partitions to a part of a stripe
CHUNK = 2_000_000         # bytes of text read at a time (and the word they end in)
FLUSH = 2_000_000         # words whose stripes a task gathers at a time
FILTER_BITS = 1 << 28     # bits of the filter of frequent pairs at most
PAIR_BITS = 16            # bits of the filter for a frequent pair, about

#: Characters that end a piece; blank and tab end a word.
ENDS = b".,;:!?\n\x0b\x0c\r"
_AS_MARKS = bytes.maketrans(ENDS + b"\t", b"." * len(ENDS) + b" ")
_GAP = re.compile(rb"[\x20.]")

STRIPES = "lang string, prefix binary, part int, nexts array<binary>, counts array<long>"


def tokens(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lists of lower-case words in order, ``.`` between pieces and after
    every text; a text is cut into chunks between words."""
    for text in texts:
        at = 0
        while at < len(text):
            end = at + CHUNK
            chunk = text[at:end].lower().translate(_AS_MARKS)
            if end < len(text):  # up to the end of a word
                more = re.compile(rb"[^\x20\x09" + re.escape(ENDS) + rb"]*").match(text, end)
                chunk += more.group().lower()
                end = more.end()
            at = end
            yield chunk.replace(b".", b" . ").split()
        yield [b"."]


def word_streams(langs: pa.Array, texts: pa.Array, ahead: int) -> Iterator[
        tuple[str, np.ndarray, list[bytes]]]:
    """(lang, numbers, words): the words of every language's texts, about FLUSH
    at a time, as places in ``words``; number 0 is the mark. The last ``ahead``
    words come again at the beginning of the next lot."""
    for lang in pc.unique(langs).to_pylist():
        place, waiting, size = {b".": 0}, [], 0
        for some in tokens(t.as_py() for t in texts.filter(pc.equal(langs, lang))):
            coded = pa.array(some, pa.binary()).dictionary_encode()
            known = np.array([place.setdefault(w, len(place)) for w in coded.dictionary.to_pylist()],
                             np.int64)
            waiting.append(known[coded.indices.to_numpy()])
            size += len(some)
            if size > FLUSH:
                numbers, words = np.concatenate(waiting), list(place)
                yield lang, numbers, words
                place, waiting, size = {b".": 0}, [], 0
                again = [words[i] for i in numbers[-ahead:]]
                waiting.append(np.array([place.setdefault(w, len(place)) for w in again], np.int64))
        if size:
            yield lang, np.concatenate(waiting), list(place)


def one_word_entries(numbers: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(prefix, next) of every word; number ``n`` is the end of a piece."""
    first, second = numbers[:-1], numbers[1:]
    own = first != 0
    return first[own], np.where(second == 0, n, second)[own]


def stripes(prefix: np.ndarray, following: np.ndarray, words: list[bytes], parts: int) -> tuple[
        np.ndarray, pa.Array, pa.Array, pa.Array]:
    """(prefix, part, nexts, counts): the entries counted and grouped into
    stripes; a prefix stays a number."""
    side = len(words) + 1
    code, counts = np.unique(prefix * side + following, return_counts=True)
    prefix, following = code // side, code % side
    of_word = np.array([zlib.crc32(w) % parts for w in words] + [0], np.int64)
    stripe = prefix * parts + of_word[following]
    order = np.argsort(stripe, kind="stable")
    stripe, following, counts = stripe[order], following[order], counts[order]
    starts = np.flatnonzero(np.diff(stripe, prepend=-1))
    offsets = pa.array(np.append(starts, len(following)), pa.int32())
    nexts = pa.array([*words, b""], pa.binary()).take(pa.array(following))
    return (stripe[starts] // parts, pa.array(stripe[starts] % parts, pa.int32()),
            pa.ListArray.from_arrays(offsets, nexts),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())))


def texts_by_lang(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def batches_of(lang: str, prefixes: pa.Array, part: pa.Array, nexts: pa.Array, counts: pa.Array,
               schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    step = 50_000  # stripes to a batch
    for at in range(0, len(prefixes), step):
        own = prefixes.slice(at, step)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(own), pa.string()), own, part.slice(at, step),
             nexts.slice(at, step), counts.slice(at, step)], schema=schema)


def one_word_stripes(docs: DataFrame, parts: int) -> DataFrame:
    """Stripes of one-word prefixes (STRIPES), by lots of a task's words."""
    schema = arrow_schema(STRIPES)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, numbers, words in word_streams(batch.column("lang"), texts, 1):
                prefix, *stripe = stripes(*one_word_entries(numbers, len(words)), words, parts)
                names = pa.array(words, pa.binary()).take(pa.array(prefix))
                yield from batches_of(lang, names, *stripe, schema)

    return texts_by_lang(docs).mapInArrow(run, STRIPES)


def word_hashes(lang: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(first, second): numbers of 64 bits whose sum names a pair of words."""
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()) | 1)
    return own * seed, own * np.uint64(0x9E3779B97F4A7C15) ^ (own >> np.uint64(31))


def places(pair: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a pair in a filter of ``bits`` bits (a power of two)."""
    pair = (pair ^ (pair >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    pair = pair ^ (pair >> np.uint64(29))
    mask = np.uint64(bits - 1)
    return ((pair & mask).astype(np.int64),
            (((pair >> np.uint64(33)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) & mask).astype(np.int64))


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """Bloom filter of the pairs (lang, prefix, next): 32-bit words, at most
    FILTER_BITS / 32 of them to the driver."""
    bits = 1 << 16
    while bits < min(FILTER_BITS, PAIR_BITS * pairs.count()):
        bits *= 2

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("lang", "prefix", "next")]
            found = []
            for lang in set(cols[0]):
                own = [(a.encode(), b.encode()) for g, a, b in zip(*cols, strict=True) if g == lang]
                first, _ = word_hashes(lang, [a for a, _ in own])
                _, second = word_hashes(lang, [b for _, b in own])
                found += places(first + second, bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, []]), pa.int64())], names=["bit"])

    on = (pairs.select("lang", "prefix", "next").mapInArrow(run, "bit long")
          .groupBy(F.shiftright("bit", 5).alias("at"))
          .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("on")).toArrow())
    filt = np.zeros(bits // 32, np.uint32)
    filt[on["at"].to_numpy()] = on["on"].to_numpy().astype(np.uint32)
    return filt


def two_word_stripes(docs: DataFrame, filt: np.ndarray, parts: int) -> DataFrame:
    """Stripes of two-word prefixes (STRIPES) of what passes the filter."""
    schema = arrow_schema(STRIPES)
    shared = docs.sparkSession.sparkContext.broadcast(filt)  # FILTER_BITS bits at most

    def run(batches):
        on = shared.value
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, numbers, words in word_streams(batch.column("lang"), texts, 2):
                left, right = word_hashes(lang, words)
                # a pair is looked up where it stands: neighbours without a mark
                a, b = places(left[numbers[:-1]] + right[numbers[1:]], len(on) * 32)
                frequent = ((on[a >> 5] >> (a & 31).astype(np.uint32))
                            & (on[b >> 5] >> (b & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)
                frequent &= (numbers[:-1] != 0) & (numbers[1:] != 0)
                at = np.flatnonzero(frequent[:-1] & frequent[1:])
                pairs, pair = np.unique(numbers[at] * len(words) + numbers[at + 1], return_inverse=True)
                prefix, *stripe = stripes(pair, numbers[at + 2], words, parts)
                names, pairs = pa.array(words, pa.binary()), pairs[prefix]
                heads = names.take(pa.array(pairs // len(words)))
                tails = names.take(pa.array(pairs % len(words)))
                both = pc.binary_join_element_wise(heads, tails, pa.scalar(b" ", pa.binary()))
                yield from batches_of(lang, both, *stripe, schema)

    return texts_by_lang(docs).mapInArrow(run, STRIPES)


def merged(stripe: DataFrame, least: int) -> DataFrame:
    """(lang, prefix, next, c): of every merged stripe its extensions found
    ``least`` times or more, and with a null ``next`` the sum of the others
    (one row for each part of the stripe)."""
    entries = (stripe.withColumn("prefix", F.col("prefix").cast("string"))
               .repartition("lang", "prefix", "part")
               .select("lang", "prefix", "part", F.inline(F.arrays_zip("nexts", "counts")))
               .withColumn("next", F.col("nexts").cast("string")))
    # both groupings keep the stripes where they are: no more exchange
    whole = entries.groupBy("lang", "prefix", "part", "next").agg(F.sum("counts").alias("c"))
    kept = F.when(F.col("c") >= least, F.col("next"))
    return (whole.groupBy("lang", "prefix", "part", kept.alias("next"))
            .agg(F.sum("c").alias("c")).drop("part"))


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a^2 / (left right)) in whole numbers of 38 digits."""
    def d(c: str) -> str:
        return f"cast({c} AS decimal(15,0))"
    return F.expr(f"({d(a)} * {d(a)} * cast(1000000 AS decimal(7,0))) div ({d(left)} * {d(right)})")


def counts_of(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(words, pairs, triples, totals): what occurs ``least`` times or more,
    and the number of words per language. ``longer`` of a pair is its most
    frequent extension to the right."""
    parts = max(PARTS, docs.rdd.getNumPartitions() // SPREAD)
    one = stored(merged(one_word_stripes(docs, parts), least), "one-word-stripes")
    totals = one.groupBy("lang").agg(F.sum("c").alias("n"))
    words = stored(one.groupBy("lang", "prefix").agg(F.sum("c").alias("f"))
                   .where(F.col("f") >= least), "words")
    found = one.where(F.col("next") != "")
    two = merged(two_word_stripes(docs, pair_filter(found), parts), least)
    triples = stored(two.where(F.col("next") != "").select(
        "lang", "prefix", F.col("next").alias("w3"), F.col("c").alias("a")), "triples")
    longer = triples.groupBy("lang", "prefix").agg(F.max("a").alias("longer"))
    pairs = stored(found.select("lang", F.concat_ws(" ", "prefix", "next").alias("prefix"),
                                F.col("c").alias("f")).join(longer, ["lang", "prefix"], "left"), "pairs")
    return words, pairs, triples, totals


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every
    language."""
    words, pairs, triples, totals = counts_of(docs, least)

    def word(name: str, count: str) -> DataFrame:
        return words.select("lang", F.col("prefix").alias(name), F.col("f").alias(count))

    def pair(name: str, count: str) -> DataFrame:
        return pairs.select("lang", F.col("prefix").alias(name), F.col("f").alias(count))

    head, tail = F.substring_index("prefix", " ", 1), F.substring_index("prefix", " ", -1)
    rest = F.concat_ws(" ", "w2", "w3")
    three = triples.select("lang", "prefix", "w3", "a", head.alias("w1"), tail.alias("w2")) \
        .withColumn("rest", rest)
    to_left = three.groupBy("lang", F.col("rest").alias("prefix")).agg(F.max("a").alias("left"))
    two = (pairs.withColumnRenamed("f", "a").join(to_left, ["lang", "prefix"], "left")
           .where(100 * F.greatest(F.coalesce("longer", F.lit(0)), F.coalesce("left", F.lit(0)))
                  < share * F.col("a"))
           .select("lang", F.col("prefix").alias("phrase"), "a", head.alias("w1"), tail.alias("w2"))
           .join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
           .withColumn("score", score("a", "l", "r")))
    cut = (three.join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
           .join(pair("rest", "r1"), ["lang", "rest"]).join(pair("prefix", "l2"), ["lang", "prefix"])
           .withColumn("s1", score("a", "l1", "r1")).withColumn("s2", score("a", "l2", "r2")))
    lower = F.col("s1") <= F.col("s2")
    cut = cut.select("lang", F.concat_ws(" ", "prefix", "w3").alias("phrase"), "a",
                     F.when(lower, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                     F.when(lower, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                     F.least("s1", "s2").alias("score"))
    found = two.select(*cut.columns).unionByName(cut)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (found.withColumn("rank", F.row_number().over(best).cast("long"))
            .where(F.col("rank") <= top).join(F.broadcast(totals), "lang")  # a row per language
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(docs: DataFrame) -> DataFrame:
    return collocations(docs)
