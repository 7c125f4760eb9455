"""DataFrame operators of the question bank: lookups, frameworks, de-duplication, pages, deltas, summaries and contracts."""
