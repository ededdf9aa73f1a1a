"""Layered publication data on Spark: landed JSON to raw, cleaned, star and mart tables."""
