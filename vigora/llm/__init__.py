"""Operators for corpora of texts; nothing else in the library imports this subpackage."""
