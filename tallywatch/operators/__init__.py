"""Distributed operators: quality gates, windows, statistics, tables, dimensions."""
