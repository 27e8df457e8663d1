"""A Spark-first engine for text corpora, retrieval and conversation analytics."""
