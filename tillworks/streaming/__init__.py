"""Incremental loading of files as they arrive."""
