"""Operators of a training-data pipeline over documents, embeddings and benchmark items.

Each module holds one operator with its own interface; ``queries`` has the thin registered queries and
``oracles`` their SQL. Nothing else in the library imports this package.
"""
