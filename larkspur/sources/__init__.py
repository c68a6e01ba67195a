"""Readers and line parsers. Parsers add a ``status`` column and keep bad lines apart."""
