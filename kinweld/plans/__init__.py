"""Whole pipelines, queries over the provided tables, command line."""
