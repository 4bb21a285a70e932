"""Operators for large text corpora (training-data pipelines).

Nothing else in the library imports this package. Each module holds one
operator with its own interface; ``queries`` registers one ``opN_<name>`` query
per operator.
"""
