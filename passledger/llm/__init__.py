"""Operators for preparing large-scale training text.

Nothing else in the library imports this subpackage; `queries` holds the thin
queries and their SQL, every other module one operator with a general interface.
"""
