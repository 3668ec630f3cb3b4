"""Incremental runs over newly arrived manifests."""
