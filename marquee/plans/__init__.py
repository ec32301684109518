"""Whole pipelines and queries, composed from the operators."""
