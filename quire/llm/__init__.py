"""Training-data operators: language, URLs, quality, near-duplicates, packing, mixing, language models.

Nothing outside this subpackage imports it; `queries` holds the registered queries and their SQL.
"""
