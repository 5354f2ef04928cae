"""Readers: scheduler text, XML records, id lists, edge lists and command batches."""
