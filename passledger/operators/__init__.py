"""Audits and the joins, windows and sets that they are made of."""
