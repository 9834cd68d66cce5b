"""Operators for training corpora: extraction, filters, fingerprints, de-duplication, sampling.

One module per operator. Each has a general interface of its own; ``queries`` applies it to the test
tables and derives the columns that a query returns. Nothing outside this package imports it.
"""
