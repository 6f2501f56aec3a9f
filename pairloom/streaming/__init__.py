"""Continuous arrival of record files."""
