"""Readers, writers and SQL names."""
