"""Streaming operators: online log windows."""
