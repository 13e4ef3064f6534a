"""Catalog analytics and maintenance plans over a snapshot-versioned lake."""
