"""quarry — a Spark-native engine for searching and ranking a collection of
web pages held as tables.

Sub-packages:

* ``sources``   — table loaders, directory/CSV sources and sinks.
* ``functions`` — Column-expression builders (HTML, URL, text analysis).
* ``operators`` — DataFrame operators (link graph, PageRank, index, search,
  suggestion, related results, frontier, view).
* ``streaming`` — request-log replays, debounce, stream ingestion.
* ``plans``     — the named query catalogue used by ``__spark_entry__``.
"""

__all__ = ["session"]
