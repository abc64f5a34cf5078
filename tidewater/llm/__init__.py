"""Operators of a large-scale training-data preparation job (texts and web pages).

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
