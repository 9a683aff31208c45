"""Operators of a training-data pipeline, one module per operator.

Nothing outside this folder imports it; ``queries`` holds the registered
queries and their SQL, ``common`` the helpers that several operators share.
"""
