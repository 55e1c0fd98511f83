"""Operators of a training-data pipeline over the `documents`, `pages`, `embeddings`
and `labels` tables. Nothing outside this package imports it."""
