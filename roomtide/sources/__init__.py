"""Readers of the logical tables and the scans on top of them."""
