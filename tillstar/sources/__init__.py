"""Declared source tables, readers, and source shapes derived from the sample tables."""
