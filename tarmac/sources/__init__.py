"""Readers for landed documents and dimensions, and writers for keyed tables."""
