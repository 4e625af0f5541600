"""Batch retrieval experiments as Spark jobs: index, search, evaluate, tune, compare."""
