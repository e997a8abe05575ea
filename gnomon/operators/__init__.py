"""Operators over label, panorama and run tables."""
