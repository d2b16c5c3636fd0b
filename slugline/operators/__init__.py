"""Transformations from DataFrame to DataFrame, and the writers."""
