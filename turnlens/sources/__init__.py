"""Readers, writers and materialised tables."""
