"""Refreshing the tables when new raw files arrive."""
