"""Stored collections, images, tables and reports."""
