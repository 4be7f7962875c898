"""Relational operators: joins, upserts, aggregates, de-duplication, sorts."""
