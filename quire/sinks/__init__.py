"""Sinks: where a load's items can go besides the bucket tables."""
