"""Readers and writers of sample tables."""
