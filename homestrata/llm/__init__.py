"""Operators for preparing training data: one module each, with their queries and SQL twins.

Nothing outside this package imports it.
"""
