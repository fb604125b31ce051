"""Staging relations, marts, views and key figures."""
