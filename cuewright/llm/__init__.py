"""Operators for large training corpora.

Nothing outside this package imports it; ``registry`` holds its queries and SQL.
"""
