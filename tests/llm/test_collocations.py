import random
import re
from collections import Counter

import pyarrow as pa

from quarry.llm import collocations as C
from quarry.llm.catalog import oracle_sql

from .fixtures import ODD, frame


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(docs, least, share, top):
    """docs: (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for p in pieces(text):
            n[lang] += len(p)
            for m in (1, 2, 3):
                f.update((lang, tuple(p[i:i + m])) for i in range(len(p) - m + 1))
    found = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= least:
            cuts = [(10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            s, k = min(cuts)
            found[lang, w] = (s, a, f[lang, w[:k]], f[lang, w[k:]])
    for lang, w in list(found):
        for big, other in ((b, v) for (g, b), v in found.items() if g == lang and len(b) == 3):
            if len(w) == 2 and w in (big[:2], big[1:]) and (lang, w) in found \
                    and 100 * other[1] >= share * found[lang, w][1]:
                f[lang, w, "gone"] = 1
    rows = []
    for lang in n:
        own = sorted((-s, -a, " ".join(w).encode(), lo, r) for (g, w), (s, a, lo, r) in found.items()
                     if g == lang and not f.get((g, w, "gone")))
        rows += [(lang, i + 1, w.decode(), -a, lo, r, n[lang], -s)
                 for i, (s, a, w, lo, r) in enumerate(own[:top])]
    return sorted(rows)


def table(spark, docs):
    return spark.createDataFrame([(i, t, g, "x", "x") for i, (g, t) in enumerate(docs)],
                                 "doc_id long, text string, lang string, next string, prefix string")


def some_docs(seed, count):
    rng = random.Random(seed)
    words = ["der", "The", "naïve", "É", "a", "b-c", "😀", "x y", "w" * 40, "1"]
    out = []
    for _ in range(count):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choices(words, [9, 8, 7, 6, 5, 4, 3, 2, 1, 1])[0]
            text += rng.choices([" ", "\t ", ". ", ",", "\n", "\x0b", " ! "], [12, 2, 1, 1, 1, 1, 1])[0]
        out.append((rng.choice(["en", "en", "fr", None]), text))
    return out


def test_against_brute_force(spark):
    docs = some_docs(3, 150) + [("en", None), ("fr", ""), ("und", "The a b-c"), ("en", ". . ,")]
    for least, share, top in ((10, 50, 2000), (3, 80, 25)):
        got = C.collocations(table(spark, docs).repartition(4), least, share, top).collect()
        assert sorted(tuple(r) for r in got) == brute(docs, least, share, top)


def test_long_texts_are_read_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 64)
    docs = some_docs(5, 60)
    whole = [("en", " ".join(t for _, t in docs)), ("en", "y" * 300 + " The a"), ("en", "The a " * 50)]
    got = [some for some in C.tokens(t.encode() for _, t in whole)]
    assert max(sum(map(len, some)) for some in got) <= 64 + 300
    words = []
    for some in got:
        words += some
    want = [w.encode() for _, t in whole for p in pieces(t) for w in [*p, "."]]
    squeeze = lambda ws: [w for w, v in zip(ws, [b".", *ws], strict=False) if (w, v) != (b".", b".")]
    assert squeeze(words) == squeeze(want)


def test_lots_of_words_overlap(monkeypatch):
    """Stripes of lots of words, merged, are those of the whole (the mapper's
    steps, run here: a worker process would not see the small lots)."""
    monkeypatch.setattr(C, "CHUNK", 64)
    monkeypatch.setattr(C, "FLUSH", 10)
    docs = some_docs(5, 60)
    whole = [(lang or "und", t) for lang, t in docs] + [("en", "y" * 300 + " The a"), ("en", "The a " * 50)]
    langs, texts = pa.array([lang for lang, _ in whole]), pa.array([t.encode() for _, t in whole])
    one, two, lots = Counter(), Counter(), 0
    for lang, numbers, words in C.word_streams(langs, texts, 1):
        lots += 1
        prefix, *rest = C.stripes(*C.one_word_entries(numbers, len(words)), words, 4)
        for p, ns, cs in zip(prefix, rest[1].to_pylist(), rest[2].to_pylist(), strict=True):
            one.update({(lang, words[p], n): c for n, c in zip(ns, cs, strict=True)})
    for lang, numbers, words in C.word_streams(langs, texts, 2):
        for a, b, c in zip(numbers, numbers[1:], numbers[2:], strict=False):
            if a and b and c:
                two[lang, words[a], words[b], words[c]] += 1
    assert lots > 30
    want, triples = Counter(), Counter()
    for lang, t in whole:
        for p in pieces(t):
            p = [w.encode() for w in p]
            want.update((lang, w, n) for w, n in zip(p, [*p[1:], b""], strict=False))
            triples.update((lang, *p[i:i + 3]) for i in range(len(p) - 2))
    assert one == want and two == triples


def test_pair_filter_has_every_pair(spark):
    pairs = [(g, f"w{i}", f"é{i % 17}") for g in ("en", "fr") for i in range(3000)]
    filt = C.pair_filter(spark.createDataFrame(pairs, "lang string, prefix string, next string").repartition(3))
    def has(lang, a, b):
        left, _ = C.word_hashes(lang, [x.encode() for x in a])
        _, right = C.word_hashes(lang, [x.encode() for x in b])
        on = [(filt[p >> 5] >> (p & 31).astype("uint32")) & 1 for p in C.places(left + right, len(filt) * 32)]
        return on[0] & on[1]
    for g in ("en", "fr"):
        assert has(g, [a for _, a, _ in pairs[:3000]], [b for *_, b in pairs[:3000]]).all()
    assert has("en", [b for *_, b in pairs], [a for _, a, _ in pairs]).mean() < 0.1  # the other way round


def test_odd_rows_and_empty_table(spark):
    got = C.op12_collocations(frame(spark, clash=("prefix", "next", "w1", "n"))).collect()
    want = brute([("en", t) for _, t, _ in ODD], 10, 50, 2000)
    assert sorted(tuple(r) for r in got) == want
    assert C.op12_collocations(frame(spark, [])).count() == 0


def test_products_beyond_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000, 3_000_000_001, 4_000_000_000)], "a long, l long, r long")
    assert big.select(C.score("a", "l", "r")).first()[0] == 10 ** 6 * 3_000_000_000 ** 2 // (
        3_000_000_001 * 4_000_000_000)


def test_stripes_are_merged_without_another_exchange(spark):
    import contextlib
    import io
    docs = table(spark, some_docs(1, 20))
    parts = C.one_word_stripes(docs, 8).repartition("lang", "prefix", "part")
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        (parts.selectExpr("lang", "prefix", "part", "inline(arrays_zip(nexts, counts))")
         .groupBy("lang", "prefix", "part", "nexts").sum("counts").explain())
    assert plan.getvalue().count("Exchange") == 1


def test_sql_on_given_table(spark):
    import duckdb
    path = "/root/testdata/sf0.001/documents.parquet"
    duckdb_rows = duckdb.sql(oracle_sql()["op12_collocations"].replace("documents", f"'{path}'")).fetchall()
    got = C.op12_collocations(spark.read.parquet(path)).collect()
    assert len(got) > 50 and sorted(tuple(r) for r in got) == sorted(duckdb_rows)
