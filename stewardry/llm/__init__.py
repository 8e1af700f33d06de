"""Operators for preparing training data at scale.

Each module holds one operator with a general interface; ``queries`` applies
each to a whole table. Nothing outside this folder imports it.
"""
