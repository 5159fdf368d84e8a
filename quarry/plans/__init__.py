"""The named queries of ``__spark_entry__`` with their DuckDB oracle SQL:
``corpus``, ``searching``, ``graph``, ``dictionary``, ``crawl``, ``logs``,
``related_q``; ``registry`` holds them and ``catalog`` exposes them."""
