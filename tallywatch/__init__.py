"""Transaction monitoring on Spark: gates, masking, labels, behavioural
windows, a star schema with account history, and the fraud-report queries.

Every operator is a function from DataFrame to DataFrame; see the README for
the map from operator to module.
"""
