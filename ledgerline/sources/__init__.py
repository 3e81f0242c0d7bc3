"""Readers: source feeds, generic files, tables, file inventories."""
