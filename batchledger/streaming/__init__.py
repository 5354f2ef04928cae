"""Structured Streaming: changes, status, completion and accounting of queue polls."""
