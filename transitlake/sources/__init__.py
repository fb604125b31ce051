"""Feeds, archives, landing folders and tables."""
