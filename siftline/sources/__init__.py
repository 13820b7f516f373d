"""Readers: raw topics, stage tables and lookups."""
