"""Operators for preparing language-model training corpora at cluster scale.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` depends on it.
"""
