"""Whole audits: sections, reports and the run of all checks."""
