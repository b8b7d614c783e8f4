"""Operators for preparing training data, and the queries that show them.

Nothing else in the library imports this subpackage.
"""
