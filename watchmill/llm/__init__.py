"""Operators of a training-data pipeline. Nothing outside this folder, its tests and ``corpus_pipeline`` imports it."""
