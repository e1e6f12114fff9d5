"""String helpers as Column expressions (no UDFs).

Each helper is a composition of built-in functions, so it stays inside
whole-stage codegen. Null input gives null output unless stated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The message returned for an empty argument.
EMPTY_ARGUMENT_MESSAGE = "Please check parameter pass"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentence_case(c: Column | str) -> Column:
    """Lower-case everything, then upper-case the first character only.

    ``"a b C"`` → ``"A b c"`` (unlike ``initcap``, later words stay lower).
    """
    low = F.lower(_c(c))
    return F.concat(F.upper(F.substring(low, 1, 1)), F.substr(low, F.lit(2)))


def upper_case(c: Column | str) -> Column:
    return F.upper(_c(c))


def strip_brackets(c: Column | str) -> Column:
    """Remove every ``[`` and ``]``."""
    return F.translate(_c(c), "[]", "")


def case_or_message(c: Column | str, fn: Callable[[Column], Column] = sentence_case, message: str | None = None) -> Column:
    """``fn(c)`` for a non-empty string; a fixed message for ``""`` or null."""
    col = _c(c)
    msg = EMPTY_ARGUMENT_MESSAGE if message is None else message
    return F.when(F.length(col) > 0, fn(col)).otherwise(F.lit(msg))


def replace_char(c: Column | str, ch: str) -> Column:
    """Replace every occurrence of the single character ``ch`` by a space."""
    if len(ch) != 1:
        raise ValueError("replace_char takes exactly one character")
    return F.translate(_c(c), ch, " ")


def clean_list(c: Column | str) -> Column:
    """List text → ``array<string>``: drop brackets and all whitespace, split on ``,``.

    Trailing empty items are dropped (``"[a, b,]"`` → ``["a", "b"]``) while
    leading and inner ones are kept (``",a,,b"`` → ``["", "a", "", "b"]``);
    ``""`` gives ``[""]`` and a string of commas only gives ``[]``.
    """
    cleaned = F.regexp_replace(_c(c), r"[\[\]\s]", "")
    return (
        F.when(cleaned.rlike("^,+$"), F.array().cast("array<string>"))
        .otherwise(F.split(F.regexp_replace(cleaned, ",+$", ""), ","))
    )
