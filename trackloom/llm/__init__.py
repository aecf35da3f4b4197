"""Training-data operators: dedup, scans, packing, search and classifiers.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
