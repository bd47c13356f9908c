"""Corpus search and link ranking as Spark jobs."""
