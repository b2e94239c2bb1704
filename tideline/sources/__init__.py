"""Readers of raw instrument files and tables, and writers of products."""
