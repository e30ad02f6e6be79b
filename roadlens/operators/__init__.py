"""Batch operators: DataFrame in, DataFrame out, no action, no Python code in tasks."""
