"""Incremental maintenance of merged tables."""
