"""Incremental jobs on arriving files."""
