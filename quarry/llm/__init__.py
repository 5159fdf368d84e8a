"""Operators for building language-model training data.

Each module holds one operator over a table of documents (or pages); the
registered queries and their SQL are in ``catalog``. Nothing else in the
library imports this package.
"""
