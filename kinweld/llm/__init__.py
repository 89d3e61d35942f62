"""Operators for preparing large text corpora.

Nothing outside this subpackage imports it; the rest of the library works
without it.
"""
