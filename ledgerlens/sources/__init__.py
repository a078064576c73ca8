"""Readers, writers and the adapter from the test tables."""
