import random
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import jaccard as J
from quarry.llm.common import stored, table
from quarry.llm.components import components
from tests.conftest import SF01
from tests.llm.fixtures import ODD, SCHEMA, frame, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Smallest reachable id and set size of every row."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i}:
            if root(i) != root(j) and 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return sorted((str(d), len(sets[i]), str(min(least[root(i)], default=None)))
                  for i, (d, _) in enumerate(rows))


def got(docs):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id))
                  for r in J.op7_ngram_jaccard(docs).collect())


def test_given_documents(spark):
    docs = table(spark, SF01, "documents")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def edited(text, rng, n):
    words = text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_chains_groups_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(J, "SALT_ROWS", 8)  # common shingles are salted
    rng = random.Random(4)
    rows = [(i, t) for i, t, _ in ODD]
    base, text = prose(1, 120), prose(2, 100)
    rows += [(100 + i, edited(base, rng, rng.randint(0, 9))) for i in range(60)]  # around 0.75
    for i in range(30):  # a chain: each near the one before
        text = edited(text, rng, 2)
        rows.append((300 + i, text))
    shared = prose(3, 60)
    rows += [(400 + i, shared + " " + prose(50 + i, rng.randint(10, 40))) for i in range(40)]
    rows += [(None, base), (None, "said twice without id"), (None, "said twice without id"),
             (600, "A B c d"), (601, "a b C d"), (602, "a b c d e f"), (603, "a b c d e g")]
    rng.shuffle(rows)
    docs = frame(spark, [(i, t, None) for i, t in rows], clash=("c", "root", "n", "_id", "_class")).repartition(5)
    assert got(docs) == brute(rows)
    stay = J.one_of_each(docs)
    assert stay.columns == docs.columns
    kept = sorted(str(r.doc_id) for r in stay.collect())
    named = {c for d, n, c in brute(rows) if n and c != "None"}
    empty = [d for d, n, _ in brute(rows) if not n]
    assert kept == sorted([*named, *empty, "None", "None"])


@pytest.mark.parametrize("salt_rows", [8, 10**9])
def test_all_linked_pairs(spark, monkeypatch, salt_rows):
    monkeypatch.setattr(J, "SALT_ROWS", salt_rows)
    rng = random.Random(6)
    base, other = prose(1, 120), prose(7, 90)
    rows = [(i, t) for i, t, _ in ODD] + [(100 + i, edited(base, rng, rng.randint(0, 9))) for i in range(60)]
    rows += [(300 + i, edited(other, rng, rng.randint(0, 4))) for i in range(20)]
    rows += [(600, "A B c d"), (601, "a b C d"), (602, "a b c d e f"), (603, "a b c d e g")]
    links, members = J.linked_pairs(frame(spark, [(i, t, None) for i, t in rows]).repartition(5))
    held = [(r.doc_id, r.n, r.c) for r in members.collect()]
    assert sorted((str(d), n) for d, n, _ in held) == sorted((str(d), len(shingles(t))) for d, t in rows)
    texts = {c: next(frozenset(shingles(t)) for e, t in rows if e == d) for d, _, c in held if c is not None}
    sets = sorted(set(texts.values()), key=sorted)
    assert len(sets) == len(texts)
    want = {frozenset((a, b)) for k, a in enumerate(sets) for b in sets[:k]
            if 100 * len(a & b) >= 75 * len(a | b)}
    found = [(r.a, r.b) for r in links.collect()]
    assert all(a < b for a, b in found) and len(found) == len(set(found))
    assert {frozenset((texts[a], texts[b])) for a, b in found} == want
    assert len(want) > 100


def test_empty_table(spark):
    assert J.linked_pairs(spark.createDataFrame([], SCHEMA))[0].count() == 0
    assert J.op7_ngram_jaccard(spark.createDataFrame([], SCHEMA)).count() == 0
    assert J.one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0


def test_prefixes_of_linked_sets_share_enough():
    rng = random.Random(0)
    for _ in range(300):
        n, m = rng.randint(1, 60), rng.randint(1, 60)
        both = rng.randint(0, min(n, m))
        if 100 * both < 75 * (n + m - both):
            continue
        a = sorted(rng.sample(range(10**6), n))
        b = sorted(rng.sample(a, both) + rng.sample(range(10**6, 2 * 10**6), m - both))
        need = min(J.SHARED, -(-3 * (n + m) // 7))
        assert len(set(a[:J.prefix_length(n)]) & set(b[:J.prefix_length(m)])) >= need


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))]
    links += [(100 + i, 101 + i) for i in range(40)]  # a path
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        if a != b:
            parent[max(ra, rb)] = min(ra, rb)
    df = stored(spark.createDataFrame(links, "a long, b long"), "links-test")
    out = {r.node: r.root for r in components(df).collect()}
    assert out == {x: root(x) for a, b in links if a != b for x in (a, b)}


def test_class_ids_that_collide_are_seen(spark):
    rows = spark.createDataFrame([(1, b"a"), (1, b"a"), (2, b"b")], "c long, key binary")
    assert not J.collision(rows)
    assert J.collision(rows.union(spark.createDataFrame([(2, b"c")], rows.schema)))
    a = np.array([5, 9], np.uint64)
    assert J.class_key(a, 0) != J.class_key(a, 1)


def test_bodies_are_made_in_one_python_step(spark, monkeypatch):
    """Two Python steps in a row keep twice the workers, with their memory."""
    plans, keep = {}, J.stored

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(J, "stored", watched)
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, ""), (4, None)], "doc_id long, text string")
    assert got(docs) == brute([tuple(r) for r in docs.collect()])
    assert plans["jaccard-bodies"].count("MapInArrow") == 1
