"""Training-data operators: search, mixing, tokenising, dedup, quality, toxicity,
WARC archives, page extraction, near-duplicate joins and chat formatting.

Nothing else in the library imports this package.
"""
