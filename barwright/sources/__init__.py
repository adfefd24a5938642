"""Readers of raw bars and of the published tables."""
