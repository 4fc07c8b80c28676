"""End-to-end flows and report queries composed from the operators."""
