"""Operators for large training-data corpora.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when the package is present.
"""
