"""Readers: lines, whole books and tables."""
