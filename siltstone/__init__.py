"""Spark-first retrieval, code-graph and corpus engine."""
