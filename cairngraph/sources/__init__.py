"""Readers, writers and load steps."""
