"""Readers and writers: landed pages, the raw layer, and keyed tables."""
