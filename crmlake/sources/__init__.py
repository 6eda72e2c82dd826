"""Landed payloads, lookup lists and stored tables."""
