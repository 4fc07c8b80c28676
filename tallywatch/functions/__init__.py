"""Functions of the transaction-monitoring library."""
