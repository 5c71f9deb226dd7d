"""Training-data operators: quality, toxicity, packing, tokens, fingerprints, secrets, repeats."""
