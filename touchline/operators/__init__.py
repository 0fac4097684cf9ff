"""Relational operators of the match warehouse."""
