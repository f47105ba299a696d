"""Training-data operators: near-duplicates, packing, scoring, mixing, chat.

Nothing outside this package imports it; ``queries.py`` binds the operators to
the driver tables and ``corpus_pipeline.py`` (repository top) chains five of
them.
"""
