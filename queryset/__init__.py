"""The registered queries, by theme."""
