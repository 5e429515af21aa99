"""Readers: topics, article tables, headline files, search hits and stored pages."""
