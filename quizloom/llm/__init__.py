"""Training-data operators: language ID, BPE, fingerprints, quality, exact top-k, token
counts, mixing, chat formatting, substring and near-duplicate removal, licence scans,
periodic runs, hard negatives.

Nothing outside this package imports it; ``queries`` holds its driver queries and SQL.
"""
