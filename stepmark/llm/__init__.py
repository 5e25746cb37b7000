"""Operators of a training-data pipeline: secrets, near copies, quality, extraction, mixing, tokens.

Each module holds one operator with its own general interface; `queries` applies them to the
given tables. Nothing outside this folder imports it.
"""
