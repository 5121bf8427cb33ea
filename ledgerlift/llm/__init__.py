"""Operators of a training-data pipeline, their queries and the SQL of those that SQL can express."""
