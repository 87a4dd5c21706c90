"""Operators for large-scale training-data preparation.

Each module holds one operator with a general interface; ``queries.py`` holds
the thin registered queries.  Nothing outside this folder imports it.
"""
