"""Operators on job, queue, edge and configuration tables, grouped by ``list_id``."""
