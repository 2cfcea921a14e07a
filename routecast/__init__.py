"""Routing and decoding of keyed messages, and preparation of training text,
as Spark jobs."""
