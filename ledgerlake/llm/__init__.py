"""Operators for building a training corpus, and the driver queries that apply them."""
