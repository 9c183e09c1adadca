"""Operators for preparing training corpora.

Nothing else in the library imports this package.  Each operator is a module of
its own; ``queries`` holds the registered queries and their SQL.
"""
