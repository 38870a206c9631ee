"""Training-data operators for large text corpora.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
