"""Operators for preparing training data: text, dialogue, vectors and media columns.

Nothing outside this folder imports it.
"""
