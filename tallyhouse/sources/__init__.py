"""Readers and writers of the five logical tables."""
