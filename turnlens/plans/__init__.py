"""Whole runs: corpus building and the staged diagnosis."""
