"""The audits of a growing product table, as streams."""
