"""Operators of a large-scale training-data pipeline over `documents` and `pages`."""
