"""Whole workloads: registered queries and their SQL counterparts."""
