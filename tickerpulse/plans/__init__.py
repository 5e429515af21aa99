"""The registered queries, and for most of them the same question in SQL."""
