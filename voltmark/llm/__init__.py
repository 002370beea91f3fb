"""Operators for preparing training text: deduplication, cleaning, scoring, tokenising.

Nothing outside this package imports it. Each module holds one operator with its own interface;
``queries.py`` holds the thin registered queries and ``oracles.py`` the SQL they are checked against.
"""
