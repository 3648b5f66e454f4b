"""Scalar functions as Column expressions; `python` holds the few that need Python."""
