"""Operators of training-data pipelines for language models.

Nothing outside this subpackage imports it; ``registry`` holds its queries and
their SQL.
"""
