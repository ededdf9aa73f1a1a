"""The checked queries, their roles on the supplied tables, and their SQL twins."""
