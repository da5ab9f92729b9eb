"""Endless rows: encoded micro-batches to a sink, stateful flush policy."""
