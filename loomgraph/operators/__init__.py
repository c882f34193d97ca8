"""Relational operators of the literature graph."""
