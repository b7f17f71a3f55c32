"""Readers for tables, column files, listings and manifests."""
