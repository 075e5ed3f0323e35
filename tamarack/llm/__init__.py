"""Operators for training-data pipelines.

Nothing outside this subpackage imports it.  Every operator is a function from DataFrame(s) to a
DataFrame; ``queries.py`` holds the thin contract queries over the test tables.
"""
