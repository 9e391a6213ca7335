"""Whole reports and whole jobs, composed from the operators."""
