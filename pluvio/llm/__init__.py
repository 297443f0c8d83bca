"""Operators over text corpora for training-data pipelines; nothing outside this package imports it."""
