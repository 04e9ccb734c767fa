"""Operators of a training-data pipeline, the queries that apply them, and their SQL."""
