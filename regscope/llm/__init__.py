"""Corpus preparation operators for training data (deduplication, mixing,
packing, sharding, filtering, formatting). Nothing outside this folder, its
tests and ``corpus_pipeline.py`` imports it."""
