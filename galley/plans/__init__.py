"""Whole layers: cleaned tables, star schema, marts, enrichment, and the run order."""
