"""Operators for training-data pipelines: one module per operator, one query each.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
