"""Training-data operators: deduplication, filtering, tokenising and packing of text tables.

Nothing else in the library imports this subpackage; it can be removed as a whole.
"""
