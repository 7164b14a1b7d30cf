"""Whole jobs: from files or tables to result files or tables."""
