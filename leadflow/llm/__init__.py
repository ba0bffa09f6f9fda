"""Training-data operators: dedup, extraction, search, scans, mixing, tokenisation.

Nothing else in the library imports this subpackage.
"""
