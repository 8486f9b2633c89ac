"""Incremental loading in batches and in streams."""
