"""Relational operators: joins, windows, graphs, dedup, search, snapshots."""
