"""Training-corpus operators: token files, packing, deduplication, extraction, quality and tokenizers.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
