"""Whole jobs, serving queries and the registered query catalogue."""
