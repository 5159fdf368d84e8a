"""Inputs and outputs: ``tables`` (parquet tables, literal
parameter tables) and ``files`` (HTML folder scan, adjacency CSV, sinks)."""
