"""One HALF_UP rounding of the raw double, held against Python's decimals."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfroll.functions.numeric import avg_units, from_units, stored_units, to_units


def _cents(x: Decimal) -> int:
    return int((x * 100).quantize(Decimal(1), ROUND_HALF_UP))


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.integers(min_value=-(10**13), max_value=10**13), min_size=50, max_size=200),
    st.lists(st.integers(min_value=-(10**14), max_value=10**14), min_size=50, max_size=200),
    st.lists(st.tuples(st.integers(0, 10**7), st.integers(0, 100)), min_size=50, max_size=200),
)
def test_to_units_rounds_the_decimal_value_once(spark, four_place, seven_place, products):
    want = [(k / 1e4, _cents(Decimal(k).scaleb(-4))) for k in four_place]
    want += [(k / 1e7, _cents(Decimal(k).scaleb(-7))) for k in seven_place]
    # price (2 places) × discount (2 places), computed in double like the facts are
    want += [((p / 100.0) * (d / 100.0) + 0.0, _cents(Decimal(p * d).scaleb(-4))) for p, d in products]
    df = spark.createDataFrame([(x, i) for i, (x, _) in enumerate(want)], "x double, i int")
    got = {r.i: r.a for r in df.select("i", to_units("x").alias("a")).collect()}
    assert all(got[i] == w for i, (_, w) in enumerate(want))


def test_values_just_below_a_tie_stay_below(spark):
    df = spark.createDataFrame([(2.00499,), (0.00495,), (12.344951,), (2.005,), (-2.005,), (1.0049999,), (8e10,)], "x double")
    assert [r[0] for r in df.select(to_units("x")).collect()] == [200, 0, 1234, 201, -201, 100, 8 * 10**12]


@settings(max_examples=8, deadline=None, phases=[Phase.generate])
@given(
    st.lists(st.tuples(st.integers(-(10**7), 10**7), st.integers(1, 9), st.integers(6, 12)), min_size=100, max_size=300),
    st.lists(st.tuples(st.integers(1, 10**15), st.integers(-18, 4)), min_size=100, max_size=300),
)
def test_every_decimal_is_rounded_as_it_stands(spark, near_ties, shortest):
    """Decimals just below, at and above ties to 12 places, and doubles of any size, against Python's decimals."""
    values = []
    for k, step, places in near_ties:
        tie = (Decimal(k) * 2 + 1) / 200
        values += [tie, tie - Decimal(step).scaleb(-places), tie + Decimal(step).scaleb(-places)]
    values += [Decimal(m).scaleb(e) for m, e in shortest if abs(Decimal(m).scaleb(e)) < Decimal(10) ** 13]
    # a double stands for its shortest decimal; 15 digits tell it apart from its neighbours
    values = [v for v in values if len(v.normalize().as_tuple().digits) <= 15]
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(values)], "x double, i int")
    got = {r.i: r.a for r in df.select("i", to_units("x").alias("a")).collect()}
    assert all(got[i] == _cents(v) for i, v in enumerate(values))


def test_values_below_a_tie_and_large_values(spark):
    cases = [
        (2.004999999, 200), (2.00499999999, 200), (2.0049999999999, 200), (2.005, 201), (0.005, 1), (0.004999999999, 0), (-0.005, -1), (1e11, 10**13),
        (123456789012.345, 12345678901235), (9e13 + 0.25, 9 * 10**15 + 25), (9e16, 9 * 10**18), (-1e15, -(10**17)), (0.0, 0), (-0.0, 0), (5e-324, 0), (1.15 * 0.3, 35),
        (1.005, 101), (0.285, 29), (1.255, 126), (99999999.995, 10**10),
    ]
    df = spark.createDataFrame([(x, i) for i, (x, _) in enumerate(cases)], "x double, i int")
    got = {r.i: r.a for r in df.select("i", to_units("x").alias("a")).collect()}
    assert {cases[i][0]: a for i, a in got.items()} == dict(cases)
    assert spark.createDataFrame([(None,)], "x double").select(to_units("x")).first()[0] is None


def test_the_same_rounding_whatever_the_rows_around(spark):
    """No switch by size: a value rounds alike in a table of one row and in one of many."""
    one = spark.createDataFrame([(2.004999999,)], "x double").select(to_units("x")).first()[0]
    many = spark.range(10_000).select((F.lit(2.004999999) + 0 * F.col("id")).alias("x")).select(to_units("x").alias("a")).distinct().collect()
    assert [r.a for r in many] == [one] == [200]


def test_stored_units_and_average_rounding(spark):
    df = spark.createDataFrame([(12.35,), (0.1 + 0.2,), (-7.05,)], "x double")
    assert [r[0] for r in df.select(stored_units("x", 2)).collect()] == [1235, 30, -705]
    # HALF_UP at the requested scale, null for an empty group
    t = spark.createDataFrame([(1, 3), (2, 3), (-1, 2), (5, 0)], "s long, n long")
    got = [r[0] for r in t.select(avg_units(F.col("s"), F.col("n"), 2, 6)).collect()]
    assert got == [3333, 6667, -5000, None]
    assert spark.range(1).select(from_units(F.lit(1235), 2)).first()[0] == 12.35
