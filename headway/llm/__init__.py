"""Operators for large training-data corpora (crawl filtering, deduplication,
scoring, mixing, tokenising).  Nothing else in :mod:`headway` imports this
subpackage; its queries are listed in :mod:`headway.llm.queries`.
"""
