"""Training-data operators: dedup, quality, packing, language, scoring, extraction, tokens.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
