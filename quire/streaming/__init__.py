"""Structured Streaming form of the sync: landed snapshots in, refreshed bucket out."""
