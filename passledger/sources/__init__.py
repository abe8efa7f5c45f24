"""Readers of granule metadata and product tags."""
