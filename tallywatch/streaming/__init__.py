"""Streaming of the transaction-monitoring library."""
