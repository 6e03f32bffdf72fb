"""Pipelines and named questions, put together from the operators."""
