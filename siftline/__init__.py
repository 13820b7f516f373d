"""Siftline: security-log parsing, routing, reduction and enrichment as Spark jobs."""

__version__ = "0.1.0"
