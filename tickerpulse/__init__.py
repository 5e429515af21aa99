"""Financial-news sentiment on Spark: messages, text features, scores, evaluation."""

__version__ = "0.1.0"
