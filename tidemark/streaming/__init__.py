"""Continuous arrival of files."""
