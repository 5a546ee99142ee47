"""Operators for preparing language-model training data.

Each module holds one operator; ``queries.py`` registers one query per operator
over the ``documents`` table.  Nothing else in the library imports this package.
"""
