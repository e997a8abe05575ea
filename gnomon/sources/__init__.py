"""Typed readers, writers and the views built from the star-schema tables."""
