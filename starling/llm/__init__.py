"""Operators of a training-data pipeline (quality, dedup, PII, mixing, tokens, search).

Nothing else in the package imports this subpackage; ``queries`` registers one
query per operator and ``corpus_pipeline.py`` at the repository top chains five.
"""
