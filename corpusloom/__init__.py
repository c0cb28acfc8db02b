"""Corpus preparation and token analytics as Spark jobs."""
