"""Training-data operators: token stores, scans, scoring, deduplication and packing.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
