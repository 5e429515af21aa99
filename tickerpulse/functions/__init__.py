"""Column functions: pure expressions, usable on batch and streaming frames alike."""
