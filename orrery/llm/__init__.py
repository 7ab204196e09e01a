"""Operators for preparing training data, each a Spark job over a documents table.

Nothing outside this package imports it; ``queries.py`` holds the thin
registered queries and the operators keep general interfaces of their own.
"""
