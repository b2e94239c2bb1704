"""Composed products, and the catalog of named queries over the given tables."""
