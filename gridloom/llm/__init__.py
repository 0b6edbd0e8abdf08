"""Training-data operators: tokenising, cleaning, scoring, deduplicating and sharding text corpora.

Nothing outside this subpackage imports it; ``queries.py`` registers its queries.
"""
