"""Exact arithmetic for the roll-ups, in integer units.

Rounding a double with ``round(x, 2)`` depends on the binary representation
of ``x`` (two engines can disagree on ``round(price * discount, 2)``). The
rule here is one HALF_UP rounding: a value is compared with the ties
themselves, each the correctly rounded quotient of two integers, and counts as
a tie from ``SLACK`` (six units of roundoff, relative) below it on. That
covers the error of a product of two decimal inputs and nothing else: a product
is taken as the number it stands for, while 2.004999999, or any value that is
really below the tie, stays below. Units are 64-bit integers: measures up to
9×10^16 in magnitude; beyond, the cast to ``long`` is an error, not a wrong cent.

Aggregates run on ``long`` units (cents for sums, millionths for daily
averages, rounded HALF_UP to six places): per-row work stays in 64-bit integers (Spark would otherwise sum
``decimal(27,2)`` with a ``BigDecimal`` per row), totals are exact and do not
depend on the order rows reach an aggregate (partitioning, retries, AQE), so
reruns are bit-identical. Averages are rounded HALF_UP once per group.
Values become doubles only at the end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

#: relative distance below a tie that the rounding errors of two inputs and their product can make
SLACK = 6 * 2.0**-53
#: and never more than this part of a unit, however large the value
MOST_SLACK = 0.05
#: decimals carried by daily sums and daily averages (see schema.Metric.scale)
SUM_SCALE = 2
AVG_SCALE = 6


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_units(c: Column | str, scale: int = 2) -> Column:
    """A raw double measure → HALF_UP-rounded integer units of 10^-scale (long)."""
    # short on purpose: eight measures must fit a method the JVM compiles (8,000 bytes of code)
    size = F.abs(_c(c))
    unit = float(10**scale)
    below = (size * unit).cast("long")  # the product may be off by one unit of roundoff: the tie above decides
    tie = (below * 2.0 + 1.0) / (2.0 * unit)
    reaches = F.when(size >= tie - F.least(tie * SLACK, F.lit(MOST_SLACK / unit)), 1.0).otherwise(0.0)
    return ((below + reaches) * F.signum(_c(c))).cast("long")


def round_half_up(c: Column | str, scale: int = 2) -> Column:
    """The same rounding as :func:`to_units`, as ``decimal(18, scale)``."""
    return (to_units(c, scale).cast(DecimalType(18, 0)) * F.lit(Decimal(1).scaleb(-scale))).cast(DecimalType(18, scale))


def stored_units(c: Column | str, scale: int) -> Column:
    """A stored double that holds an exact ``scale``-place value → its integer units.

    The double is within far less than half a unit of the value written, so
    rounding to the nearest integer recovers it exactly (``rint`` is a plain
    floating-point operation, no per-row ``BigDecimal``).
    """
    return F.rint(_c(c) * float(10**scale)).cast("long")


def from_units(u: Column, scale: int) -> Column:
    """Integer units → double (one correctly rounded division)."""
    return (u.cast("double") / float(10**scale)).cast("double")


def avg_units(total: Column, n: Column, in_scale: int, out_scale: int) -> Column:
    """HALF_UP(total / n) in units of 10^-out_scale, for ``total`` in units of 10^-in_scale.

    Evaluated once per group, in decimal; null when ``n`` is 0.
    """
    shift = out_scale - in_scale
    q = F.round(total.cast(DecimalType(20, 0)) / n.cast(DecimalType(20, 0)), shift)
    return F.when(n > 0, (q * (10**shift)).cast("long"))


def sum_as_double(units: Column, scale: int) -> Column:
    """Aggregate: exact sum of integer units, as double."""
    return from_units(F.sum(units), scale)


def avg_as_double(units: Column, in_scale: int, out_scale: int) -> Column:
    """Aggregate: HALF_UP average of integer units at ``out_scale`` places, as double."""
    return from_units(avg_units(F.sum(units), F.count(units), in_scale, out_scale), out_scale)
