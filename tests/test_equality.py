"""Metric equality against exact arithmetic in Python."""

import math
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import types as T

from countersign.functions.equality import values_match
from countersign.functions.text import value_text

NAN, INF = float("nan"), float("inf")
BIG = 2**63 - 1

VALUES = {
    "tinyint": [None, 0, 1, -128, 127],
    "int": [None, 0, 1, -1, 2**31 - 1],
    "bigint": [None, 0, 1, 9007199254740993, 9007199254740992, BIG, -(2**63)],
    "float": [None, 0.0, -0.0, 1.0, 0.5, NAN, INF, -INF],
    "double": [None, 0.0, -0.0, 1.0, 0.5, 1.1, 9007199254740992.0, 2.0**63, -(2.0**63), 1e300, NAN, INF, -INF],
    "decimal(10,2)": [None, Decimal("0.00"), Decimal("1.00"), Decimal("1.10"), Decimal("0.50")],
    "decimal(38,0)": [None, Decimal(1), Decimal(10**38 - 1), Decimal(9007199254740993), Decimal(BIG)],
    "decimal(38,18)": [None, Decimal(1), Decimal("1.1"), Decimal("1.100000000000000001"), Decimal("0.5")],
}


def equal_numbers(a, b, nan_equal=True):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (nan_equal and math.isnan(a) and math.isnan(b))
    for x, y in ((a, b), (b, a)):
        if isinstance(x, float):
            if math.isnan(x) or math.isinf(x):
                return False
            if isinstance(y, Decimal):
                # The double stands for the decimal nearest to it at the other side's scale.
                return Decimal(repr(x)) == y and float(y) == x
            return Fraction(x) == Fraction(y)
    return Fraction(a) == Fraction(b)


def pairs(spark, left, right):
    rows = [(a, b) for a in VALUES[left] for b in VALUES[right]]
    return rows, spark.createDataFrame(rows, f"a {left}, b {right}")


@pytest.mark.parametrize("left", VALUES)
@pytest.mark.parametrize("right", VALUES)
def test_all_type_pairs(spark, left, right):
    rows, df = pairs(spark, left, right)
    types = {f.name: f.dataType for f in df.schema}
    match = values_match("a", "b", types["a"], types["b"])
    for (a, b), row in zip(rows, df.selectExpr("a", "b", f"{match} AS m").collect()):
        assert row.m is equal_numbers(a, b), (left, right, a, b)


def test_nan_can_differ(spark):
    rows, df = pairs(spark, "double", "double")
    match = values_match("a", "b", T.DoubleType(), T.DoubleType(), nan_equal=False)
    for (a, b), row in zip(rows, df.selectExpr(f"{match} AS m").collect()):
        assert row.m is equal_numbers(a, b, nan_equal=False), (a, b)


@pytest.mark.parametrize(
    "a,b,expected",
    [
        (1e15, 1e15 + 1, True), (1.0, 1.1, False), (None, 1.0, False), (None, None, True),
        (INF, 5.0, False), (INF, INF, True), (INF, -INF, False), (NAN, 1.0, False), (NAN, NAN, True),
        (0.0, 0.0, True), (0.0, 1e-300, False), (-2.0, -2.0 - 1e-10, True),
    ],
)
def test_relative_tolerance(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    match = values_match("a", "b", T.DoubleType(), T.DoubleType(), rel_tol=1e-9)
    assert df.selectExpr(match).first()[0] is expected


def test_number_never_equals_text(spark):
    df = spark.createDataFrame([(1, "1"), (None, None), (None, "1")], "a int, b string")
    match = values_match("a", "b", T.IntegerType(), T.StringType())
    assert [r[0] for r in df.selectExpr(match).collect()] == [False, True, False]


def test_value_text_reads_like_a_number(spark):
    values = [0.0, 1.0, 261.5, 1e7, 12345678.9, 123456789012345.6, 9999999999999998.0, 1e-3,
              0.0001, 0.00012345, -20000000.25, 0.1 + 0.2, 3.0e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in df.selectExpr(value_text("v", T.DoubleType())).collect()]
    assert found == [repr(v) for v in values]
