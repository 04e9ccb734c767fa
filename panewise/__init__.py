"""Sliding-window analytics over ordered text and event streams, on PySpark."""
