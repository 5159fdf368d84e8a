"""Boolean match, BM25 / PageRank scoring, ranking, paging and merges
(X2-X9, U1-U3, W1-W3, J3, J8, J9, A11, A15, pins P2b, P4, P6).

A query is rows ``(query_id, group_id, field, term)``: a document matches a
group when it holds every distinct term of the group in that field, and
matches the query when any group matches. The score of a document is the sum
over its matched groups of, per term, ``a * pagerank + b * bm25``.

Plan shape (no driver loop; full rankings run the jobs of a global sort):

1. query terms ⟕ ``doc_freq`` — idf per term, groups with an unknown term drop;
2. per group: term list, size and its *rarest* term;
3. candidates = groups ⋈ postings on the rarest term only — an AND group never
   fans out over the posting list of a common word it also contains;
4. each candidate checks its other terms by an equi-join on
   ``(field, term, url)``, which is unique per posting (no hot key);
5. per (query, url) sums, then rank.

Queries of the same terms have the same results: ``query_classes`` numbers the
distinct sets of query rows, all steps above run once per class, and
``for_members`` gives the finished rows to every query of the class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.functions.constants import BM25_B, BM25_K1, PAGE_LEN, RELATED_K, SCORE_WEIGHTS, SUGGEST_SIZE
from quarry.functions.porter import with_stems
from quarry.operators.index import Index
from quarry.session import ensure_checkpoint_dir

# a class is cut into cells: so many of its queries by so many of its results
MEMBER_ROWS = 4096
RESULT_ROWS = 1024


# ---------------------------------------------------------------------------
# query rows
# ---------------------------------------------------------------------------

def analyze_groups(groups: DataFrame, stem: bool = True,
                   dedup_groups: bool = True) -> DataFrame:
    """(query_id, group_id, field, text) → (query_id, group_id, field, term).

    Each field's analyzer is applied to its text, as the query parser does.
    Identical groups of a query (same field, same term set) count once
    (``dedup_groups=False`` when every query has a single group).
    """
    title = (groups.where(F.col("field") == "title")
             .select("query_id", "group_id", "field",
                     F.explode(TX.word_tokens(F.col("text"))).alias("term")))
    content = (groups.where(F.col("field") == "content")
               .select("query_id", "group_id", "field",
                       F.explode(TX.content_tokens(F.col("text"))).alias("term")))
    if stem:  # content terms only
        content = with_stems(content)
    rows = title.unionByName(content).distinct()
    if not dedup_groups:
        return rows
    # drop duplicate groups: same field and term set within one query; the rows
    # are read twice, so their plan (suggestions, analyzers) is run and held once
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.checkpoint(eager=True)
    sig = (rows.groupBy("query_id", "group_id", "field")
           .agg(F.array_sort(F.collect_list("term")).alias("sig")))
    keep = (sig.groupBy("query_id", "field", "sig")
            .agg(F.min("group_id").alias("group_id"))
            .select("query_id", "group_id"))
    return rows.join(keep, ["query_id", "group_id"], "left_semi")


def title_queries(queries: DataFrame) -> DataFrame:
    """Plain query strings ``(query_id, query)`` → one title group each
    (the parser's default field, terms AND-ed). A null query has no terms."""
    return queries.select("query_id", F.lit(0).alias("group_id"),
                          F.lit("title").alias("field"),
                          F.col("query").alias("text"))


def query_classes(qterms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``qterms`` (``query_id`` and further columns) once for all queries whose
    rows are the same, with the number of the class for ``query_id``; and the
    members ``(query_id, qclass)``, a row per query."""
    ensure_checkpoint_dir(qterms.sparkSession)
    columns = [c for c in qterms.columns if c != "query_id"]
    own = (qterms.groupBy("query_id")
           .agg(F.array_sort(F.collect_set(F.struct(*columns))).alias("sig")).checkpoint(eager=True))
    classes = (own.select("sig").distinct()
               .withColumn("qclass", F.monotonically_increasing_id()).checkpoint(eager=True))
    members = own.join(classes.hint("merge"), "sig").select("query_id", "qclass").checkpoint(eager=True)
    return classes.select(F.col("qclass").alias("query_id"), F.inline("sig")), members


def for_members(results: DataFrame, members: DataFrame, most: int | None = None) -> DataFrame:
    """Result rows of classes (``query_id`` is the class, ``rank`` counts them)
    for every member. A large class is dealt to many tasks in cells of queries
    by results: a result row moves once for every MEMBER_ROWS queries, a query
    once for every RESULT_ROWS results, so what moves is a small part of what
    comes out. ``most`` says how many results a class can have."""
    n = int(results.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = results.withColumnRenamed("query_id", "qclass")
    band = F.floor((F.col("rank") - 1) / RESULT_ROWS).cast("int")
    sizes = members.groupBy("qclass").agg(
        F.ceil(F.count(F.lit(1)) / MEMBER_ROWS).cast("int").alias("_parts"))
    if most is None or most > RESULT_ROWS:
        sizes = sizes.join(found.groupBy("qclass").agg((F.max(band) + 1).alias("_bands")), "qclass")
    else:
        sizes = sizes.withColumn("_bands", F.lit(1))
    key = ["qclass", "_part", "_band"]
    asked = (members.join(sizes, "qclass")
             .withColumn("_part", F.pmod(F.xxhash64("query_id"), F.col("_parts")).cast("int"))
             .withColumn("_band", F.explode(F.sequence(F.lit(0), F.col("_bands") - 1)))
             .drop("_parts", "_bands").repartition(n, *key))
    found = (found.join(sizes.drop("_bands"), "qclass").withColumn("_band", band)
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
             .drop("_parts").repartition(n, *key))
    return asked.join(found, key).drop(*key)


# ---------------------------------------------------------------------------
# match + score
# ---------------------------------------------------------------------------

def bm25(idf, tf, length, avg_len, b: float = BM25_B, k1: float = BM25_K1):
    """Idf * tf*(k1+1) / (tf + k1*((1-b) + b*len/avglen))."""
    return idf * (tf * (k1 + 1)) / (tf + k1 * ((1 - b) + b * length / avg_len))


def match_groups(qterms: DataFrame, index: Index) -> DataFrame:
    """Documents matching each group, with per-term BM25.

    Returns ``(query_id, group_id, url, n_terms, bm25_sum)``.
    """
    stats = F.broadcast(index.field_stats.select("field", "n_docs", "avg_len"))  # 2 rows
    qt = (qterms.join(index.doc_freq, ["field", "term"], "left")
          .join(stats, "field")
          .withColumn("idf", F.log(F.col("n_docs") / (F.col("df") + 1)) + 1))
    groups = (qt.groupBy("query_id", "group_id", "field")
              .agg(F.count(F.lit(1)).alias("n_terms"),
                   F.count("df").alias("n_known"),
                   F.min_by("term", F.struct("df", "term")).alias("rare"),
                   F.collect_list(F.struct("term", "idf")).alias("terms"),
                   F.first("avg_len").alias("avg_len"))
              .where(F.col("n_terms") == F.col("n_known")))
    post = index.postings.select("field", "term", "url", "tf", "len")
    cand = groups.join(post.select("field", F.col("term").alias("rare"), "url"),
                       ["field", "rare"])
    per_term = (cand.select("query_id", "group_id", "field", "url", "n_terms", "avg_len",
                            F.explode("terms").alias("t"))
                .select("query_id", "group_id", "field", "url", "n_terms", "avg_len",
                        F.col("t.term").alias("term"), F.col("t.idf").alias("idf"))
                .join(post, ["field", "term", "url"]))
    return (per_term.groupBy("query_id", "group_id", "url")
            .agg(F.first("n_terms").alias("n_terms"),
                 F.count(F.lit(1)).alias("n_hit"),
                 F.sum(bm25(F.col("idf"), F.col("tf"), F.col("len"),
                            F.col("avg_len"))).alias("bm25_sum"))
            .where(F.col("n_hit") == F.col("n_terms"))
            .drop("n_hit"))


def group_scores(matches: DataFrame, mode: str = "both",
                 ranks: DataFrame | None = None) -> DataFrame:
    """The matched groups with their ``group_score``.

    ``ranks(url, pr)`` is required for the pagerank and both modes (J3): the
    PageRank term is added once per matching term.
    """
    if mode not in SCORE_WEIGHTS:
        raise ValueError(f"unknown scoring mode {mode!r}; use one of {sorted(SCORE_WEIGHTS)}")
    a, b = SCORE_WEIGHTS[mode]
    if a == 0.0:
        return matches.withColumn("group_score", b * F.col("bm25_sum"))
    if ranks is None:
        raise ValueError(f"mode {mode!r} needs a PageRank table")
    return (matches.join(ranks.select("url", "pr"), "url")
            .withColumn("group_score", a * F.col("pr") * F.col("n_terms") + b * F.col("bm25_sum")))


def score(matches: DataFrame, mode: str = "both",
          ranks: DataFrame | None = None) -> DataFrame:
    """Per (query_id, url) score summed over matched groups."""
    return (group_scores(matches, mode, ranks).groupBy("query_id", "url")
            .agg(F.sum("group_score").alias("score")))


def rank_hits(hits: DataFrame) -> DataFrame:
    """W1 / pin P9: rank all hits by score, ties by url; scores rounded (P10).

    Ranks come from a global sort on (query, score desc, url) numbered per
    partition (``sequence.group_rank``): a query matching a third of the
    corpus is sorted by many tasks, not by one window partition."""
    from quarry.operators.sequence import group_rank
    r = group_rank(hits.withColumn("score", F.round("score", 6)), ["query_id"],
                   [F.desc("score"), F.asc("url")], "rank")
    return r.withColumn("rank", F.col("rank").cast("int")).drop("_gpos")


def search(queries: DataFrame, index: Index, mode: str = "bm25",
           ranks: DataFrame | None = None, stem: bool = True) -> DataFrame:
    """Plain queries ``(query_id, query)`` → ``(query_id, url, score, rank)``."""
    # one title group per query: the title analyzer never stems
    qterms = analyze_groups(title_queries(queries), stem=False, dedup_groups=False)
    return search_terms(qterms, index, mode, ranks)


def search_terms(qterms: DataFrame, index: Index, mode: str = "bm25",
                 ranks: DataFrame | None = None) -> DataFrame:
    ranked, members = ranked_classes(qterms, index, mode, ranks)
    return for_members(ranked, members).select("query_id", "url", "score", "rank")


def ranked_classes(qterms: DataFrame, index: Index, mode: str = "bm25",
                   ranks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All hits of every class of queries, ranked, and the members."""
    rows, members = query_classes(qterms)
    hits = score(match_groups(rows, index), mode, ranks)
    return rank_hits(hits).select("query_id", "url", "score", "rank"), members


def first_hits(qterms: DataFrame, index: Index, n: int, mode: str = "bm25",
               ranks: DataFrame | None = None) -> DataFrame:
    """The first ``n`` hits of every query ``(query_id, url, score, rank)``;
    no hit beyond is ranked."""
    rows, members = query_classes(qterms)
    return for_members(top_hits(score(match_groups(rows, index), mode, ranks), n), members, n)


def upgraded_classes(expanded: DataFrame, plain: DataFrame, index: Index, mode: str = "bm25",
                     ranks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The hits of the query rows ``expanded`` with those of ``plain`` moved
    first, for every class of queries that agree in both, and the members."""
    both = (expanded.withColumn("_plain", F.lit(False))
            .unionByName(plain.withColumn("_plain", F.lit(True))))
    rows, members = query_classes(both)
    hits = score(match_groups(rows.where(~F.col("_plain")).drop("_plain"), index), mode, ranks)
    first = match_groups(rows.where(F.col("_plain")).drop("_plain"), index)
    return upgraded_search(hits, first.select("query_id", "url")), members


def submit(queries: DataFrame, index: Index, entries: DataFrame | None = None,
           mode: str = "both", ranks: DataFrame | None = None, upgrade: bool = False,
           related: DataFrame | None = None, stem: bool = True) -> DataFrame:
    """X7 with its options: ``queries(query_id, query)`` → ``(query_id, url,
    rank)``, all results.

    ``upgrade`` (X9) searches the whole-string suggestions of ``entries(key,
    title, weight)`` in the title or the query in the content, and moves what
    the plain query finds to the front. ``related`` (X10), a table of word
    vectors ``(word, vector)``, replaces the results by those of the related
    queries of the first hits. ``ranks(url, pr)`` is needed but in mode
    "bm25"; ``stem`` says whether the index holds stems."""
    plain = analyze_groups(title_queries(queries), stem=False, dedup_groups=False)
    if upgrade:
        from quarry.operators.suggest import suggestion_groups
        content = queries.select("query_id", F.lit(SUGGEST_SIZE).alias("group_id"),
                                 F.lit("content").alias("field"), F.col("query").alias("text"))
        groups = suggestion_groups(queries, entries).unionByName(content)
        ranked, members = upgraded_classes(analyze_groups(groups, stem), plain, index, mode, ranks)
    elif related is not None:  # only the first hits are read
        rows, members = query_classes(plain)
        ranked = top_hits(score(match_groups(rows, index), mode, ranks), RELATED_K)
    else:
        ranked, members = ranked_classes(plain, index, mode, ranks)
    if related is not None:
        from quarry.operators.related import related_results
        seeds = for_members(ranked.where(F.col("rank") <= RELATED_K), members, RELATED_K)
        return related_results(seeds, index, related, mode, ranks).select("query_id", "url", "rank")
    return for_members(ranked, members).select("query_id", "url", "rank")


def top_n(ranked: DataFrame, n: int) -> DataFrame:
    """The first ``n`` hits per query (repeatable stand-in for the
    time-limited collector)."""
    return ranked.where(F.col("rank") <= n)


def top_hits(hits: DataFrame, n: int) -> DataFrame:
    """The first ``n`` hits per query straight from scores: a rank-limited
    window, which Spark plans as a partial WindowGroupLimit per task before
    the shuffle — a hot query sends at most ``n`` rows per task."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("url"))
    return (hits.withColumn("score", F.round("score", 6))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))


# ---------------------------------------------------------------------------
# paging (W2, W3, A15)
# ---------------------------------------------------------------------------

def with_pages(ranked: DataFrame, page_len: int = PAGE_LEN) -> DataFrame:
    """Every hit with its page number and the query's total."""
    totals = ranked.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    return (ranked.join(totals, "query_id")
            .withColumn("page_no", F.ceil(F.col("rank") / page_len).cast("int")))


def page_slice(ranked: DataFrame, requests: DataFrame,
               page_len: int = PAGE_LEN) -> DataFrame:
    """Requested pages ``(query_id, page)``; the page number is clamped to
    at least 1 and at most the last page. Returns
    ``(query_id, page_no, total, url, rank)``, with further columns of the
    requests; a query without hits gives a single row with total 0 and no
    url."""
    totals = ranked.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    req = (requests.join(totals, "query_id", "left")
           .withColumn("total", F.coalesce(F.col("total"), F.lit(0)).cast("long"))
           .withColumn("last", F.greatest(F.ceil(F.col("total") / page_len), F.lit(1)))
           .withColumn("page_no", F.least(F.greatest(F.col("page"), F.lit(1)),
                                          F.col("last")).cast("int")))
    hits = ranked.withColumn("page_no", F.ceil(F.col("rank") / page_len).cast("int"))
    return (req.join(hits, ["query_id", "page_no"], "left")
            .select(*[c for c in requests.columns if c != "page"], "page_no", "total", "url", "rank"))


# ---------------------------------------------------------------------------
# merges (P6)
# ---------------------------------------------------------------------------

def upgrade(a: DataFrame, b: DataFrame) -> DataFrame:
    """Reorder ``a`` so documents also in ``b`` come first; the order
    inside each part is ``a``'s. Returns ``(query_id, url, exact, rank)``.
    Re-ranking uses the sort-based ``group_rank`` (a hot query is split)."""
    from quarry.operators.sequence import group_rank
    bb = b.select("query_id", "url").distinct().withColumn("exact", F.lit(True))
    m = (a.join(bb, ["query_id", "url"], "left")
         .withColumn("exact", F.coalesce(F.col("exact"), F.lit(False))))
    r = group_rank(m.select("query_id", "url", "exact", F.col("rank").alias("_a")),
                   ["query_id"], [F.desc("exact"), F.asc("_a")], "rank")
    return r.select("query_id", "url", "exact", F.col("rank").cast("int").alias("rank"))


def upgraded_search(hits_a: DataFrame, matches_b: DataFrame) -> DataFrame:
    """X9/J8 in one ranking: ``hits_a(query_id, url, score)`` unranked, and
    the documents matching the plain query ``matches_b(query_id, url)``.
    Ranking A by (in B first, score desc, url) equals ranking A and then
    upgrading it with B — without ranking either list separately, and B is
    only a set."""
    from quarry.operators.sequence import group_rank
    bb = matches_b.select("query_id", "url").distinct().withColumn("exact", F.lit(True))
    m = (hits_a.withColumn("score", F.round("score", 6))
         .join(bb, ["query_id", "url"], "left")
         .withColumn("exact", F.coalesce(F.col("exact"), F.lit(False))))
    r = group_rank(m, ["query_id"], [F.desc("exact"), F.desc("score"), F.asc("url")], "rank")
    return r.select("query_id", "url", "exact", F.col("rank").cast("int").alias("rank"))


def upgrade_and_extend(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a∩b in a's order), (a∖b in a's order), (b∖a in b's order);
    the sort-based ``group_rank`` splits a hot query."""
    aa = a.select("query_id", "url", F.col("rank").alias("ra"))
    bb = b.select("query_id", "url", F.col("rank").alias("rb"))
    m = aa.join(bb, ["query_id", "url"], "full_outer")
    from quarry.operators.sequence import group_rank
    part = (F.when(F.col("ra").isNotNull() & F.col("rb").isNotNull(), 0)
            .when(F.col("ra").isNotNull(), 1).otherwise(2))
    key = F.when(part < 2, F.col("ra")).otherwise(F.col("rb"))
    m = m.select("query_id", "url", part.alias("_part"), key.alias("_key"))
    r = group_rank(m, ["query_id"], ["_part", "_key", "url"], "rank")
    return r.select("query_id", "url", F.col("rank").cast("int").alias("rank"))
