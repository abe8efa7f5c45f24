"""Audits of production systems that turn time-stamped inputs into derived products."""
