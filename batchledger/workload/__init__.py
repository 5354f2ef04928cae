"""Queries over the benchmark tables, each with the SQL that gives the same answer."""
