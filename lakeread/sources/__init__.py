"""Catalogs, scans, loaders and generators."""
