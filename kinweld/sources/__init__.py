"""Readers that turn files into source records."""
