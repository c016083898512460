"""Operators for preparing training text. Nothing outside this subpackage and corpus_pipeline.py imports it."""
