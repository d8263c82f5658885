"""Readers of documents, queries and graphs."""
