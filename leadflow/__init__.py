"""Spark engine for territory-based lead data."""
