"""Readers: landed JSON, stored pages, catalog metadata, review files."""
