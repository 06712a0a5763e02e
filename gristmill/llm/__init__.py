"""Operators of a training-data pipeline; nothing else in the library depends on them."""
