"""Operators for building a text corpus."""
