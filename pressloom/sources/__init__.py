"""Readers and writers of the harvest tables."""
