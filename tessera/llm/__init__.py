"""Operators for building large training corpora.

Nothing else in the library imports this package; ``queries.py`` holds the
registered queries and ``__spark_entry__.py`` adds them when the package is
importable.
"""
