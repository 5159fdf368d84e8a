"""DataFrame operators: ``links`` (graph), ``pagerank``, ``index``,
``search`` (match, score, rank, page, merge), ``suggest``, ``related``
(word vectors, nearest neighbours, related results), ``frontier`` (crawl
planning), ``view`` and ``sequence`` (order-dependent helpers that split hot
groups)."""
