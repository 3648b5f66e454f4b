"""Readers of the corpus's document kinds, and writers that never overwrite what they read."""
