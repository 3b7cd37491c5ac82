"""Operators for preparing text corpora at scale: near-duplicates, secrets, fingerprints, line
chunks, token counts, transcripts, mixing, decontamination, language and quality.

Nothing else in the library imports this package. ``queries.QUERIES`` and ``queries.ORACLES`` hold
the registered queries; ``corpus_pipeline.py`` at the repository top chains five of the operators.
"""
