"""Training-data pipeline operators: filtering, deduplication, mixing, tokenizing and search.

Nothing else in the library imports this subpackage.
"""
