"""Readers: delimited file drops, file listings, tables."""
