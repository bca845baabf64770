"""Retail star-schema warehouse as PySpark DataFrame jobs."""
