"""Runs of consecutive words, as the core has them."""

from palimpsest.functions.runs import RUN, body_words, distinct_runs, jaccard, mix, run_hashes

__all__ = ["RUN", "body_words", "distinct_runs", "jaccard", "mix", "run_hashes"]
