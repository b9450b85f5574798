"""Operators for large training-data corpora, built on Spark.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``queries`` registers the ``opN_*`` queries.
"""
