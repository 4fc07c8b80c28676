"""Sources of the transaction-monitoring library."""
