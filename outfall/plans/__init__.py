"""Whole jobs, and the catalog of queries over the sample tables."""
