"""Training-data operators: deduplication, scans, tokenizers, formatting, archives.

Every operator takes a DataFrame and returns a DataFrame; nothing outside this
subpackage imports it. ``queries.py`` holds the registered queries.
"""
