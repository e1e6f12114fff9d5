"""Relational operators of the roll-up, each a pure DataFrame → DataFrame function."""
