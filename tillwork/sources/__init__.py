"""Readers, writers and the mapping from the sample tables to retail tables."""
