"""Incremental loading, batch and streaming."""
