"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this package.  ``queries`` registers one query per
operator; every operator is a function from DataFrames to DataFrames with its own interface.
"""
