"""Operators for preparing training text: one module each, and ``queries`` for all of them.

Nothing else in the library imports this package.
"""
