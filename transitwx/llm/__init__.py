"""Operators for large text corpora: filters, deduplication, mixing, sharding.

Nothing outside this folder imports it. Every operator takes a DataFrame and
returns one; ``queries.py`` holds the registered queries and their SQL.
"""
