"""Operators of a training-data pipeline: quality, toxicity, secrets, personal data,
near copies, benchmark leaks, mixing, sharding, chat rendering and token files.

Nothing else in the library imports this subpackage.
"""
