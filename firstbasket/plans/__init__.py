"""Composite plans: the base table, the reporting view, and the end-to-end stages."""
