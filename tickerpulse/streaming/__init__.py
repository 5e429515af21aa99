"""Streaming jobs: the same frame functions, with sinks and checkpoints around them."""
