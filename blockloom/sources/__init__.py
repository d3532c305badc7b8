"""Readers, writers and the mapping of star-schema tables to chain tables."""
