"""Configured datasets."""
