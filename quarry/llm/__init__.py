"""Training-data operators: quality, toxicity, tokens, packing, ordering,
fingerprints and duplicate removal over a ``documents`` table."""
