"""Operators of a training-data pipeline: dedup, decontamination, search, tokens, extraction, classifiers."""
