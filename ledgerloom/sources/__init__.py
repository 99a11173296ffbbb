"""Contracts, loading and table sinks."""
