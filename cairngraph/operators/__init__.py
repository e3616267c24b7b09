"""Joins, traversals, merges and checks over graph tables."""
