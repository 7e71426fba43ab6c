"""Operators for building and cleaning training corpora. Nothing outside this folder imports it."""
