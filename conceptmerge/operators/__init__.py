"""Operators on DataFrames of terms, edges, mentions and vectors."""
