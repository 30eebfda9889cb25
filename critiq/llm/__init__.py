"""Training-data operators: fingerprints, quality, sharding, secrets, deduplication, search, tokenising, packing.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` holds the thin
queries over the given tables and ``corpus_pipeline.py`` (repository top)
chains five of the operators.
"""
