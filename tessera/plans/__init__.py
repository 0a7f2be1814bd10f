"""Whole pipelines and the driver's queries."""
