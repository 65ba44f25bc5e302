"""Spark engine for two-speaker, time-aligned dialogue data."""
