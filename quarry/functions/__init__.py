"""Column-expression builders that run inside the JVM: ``html`` (anchors,
titles, text, popularity, images), ``urls`` (resolution, host, port),
``text`` (analyzers), ``porter`` (stems), and ``constants`` (fixed values)."""
