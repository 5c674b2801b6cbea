"""Corpus, retrieval, trajectory and graph analytics as Spark DataFrame operators."""
