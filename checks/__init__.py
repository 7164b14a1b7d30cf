"""Queries on the given tables and the SQL they must agree with."""
