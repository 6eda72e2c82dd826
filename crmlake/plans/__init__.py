"""Compositions: timeline, reporting views and loads."""
