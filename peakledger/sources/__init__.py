"""Readers: listings, report files, event streams, and feeds derived from the given tables."""
