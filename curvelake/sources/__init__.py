"""Readers, data generators, writers and catalog work."""
