"""Scalar helpers as native Column expressions (strings, dates, exact decimals)."""

from . import dates, numeric, strings

__all__ = ["dates", "numeric", "strings"]
