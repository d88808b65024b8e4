"""Training-data operators: scoring, packing, deduplication, filtering, extraction, tokenizing.

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
