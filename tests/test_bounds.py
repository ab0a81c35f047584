"""Partition bounds."""

import random

import pytest
from pyspark.sql import types as T

import countersign as cs
from countersign.functions.bounds import exclusive_end, range_condition


@pytest.mark.parametrize(
    "end,expected",
    [
        ("20250131", "20250132"), ("20260522", "20260523"), ("0101", "0102"), ("0099", "0100"),
        ("9", None), ("99999999", None), ("2025-01-01", None), ("eu", None), ("-5", None), ("1_0", None),
        ("²", None),
    ],
)
def test_exclusive_end(end, expected):
    assert exclusive_end(end) == expected


def kept(spark, keys, start=None, end=None, dtype="string"):
    df = spark.createDataFrame([(k,) for k in keys], f"pt {dtype}")
    return [r.pt for r in cs.partition_range(df, "pt", start, end).collect()]


HOURS = ["2026052123", "2026052200", "2026052223", "20260522", "2026052300", None]


def test_hourly_keys_belong_to_the_end_day(spark):
    assert kept(spark, HOURS, "20260522", "20260522") == ["2026052200", "2026052223", "20260522"]


def test_one_bound_filters_one_side_and_drops_null(spark):
    assert kept(spark, HOURS, end="20260521") == ["2026052123"]
    assert kept(spark, HOURS, start="20260523") == ["2026052300"]
    assert kept(spark, HOURS) == HOURS


def test_end_that_cannot_be_counted_up(spark):
    assert kept(spark, ["2025-01-01", "2025-01-02", "2025-01-02T05", "2025-01-03"],
                "2025-01-02", "2025-01-02") == ["2025-01-02", "2025-01-02T05"]
    assert kept(spark, ["8", "9", "95", "a"], "8", "9") == ["8", "9", "95"]


def test_leading_zero_keeps_its_width(spark):
    assert kept(spark, ["0101", "01011", "0102"], "0101", "0101") == ["0101", "01011"]


def test_quotes_in_bounds(spark):
    assert kept(spark, ["o'b\\x", "p"], "o'b\\x", "o'b\\x") == ["o'b\\x"]


def test_integral_key(spark):
    assert kept(spark, [20250101, 20250102, 20250103, None], "20250101", "20250102", "int") == [20250101, 20250102]
    assert kept(spark, [9, 10, 11], "9", "9", "bigint") == [9]
    with pytest.raises(ValueError):
        range_condition("pt", T.IntegerType(), end="2025-01-01")


def test_date_key(spark):
    from datetime import date

    days = [date(2025, 1, d) for d in (1, 2, 3)]
    assert kept(spark, days, "2025-01-01", "2025-01-02", "date") == days[:2]
    with pytest.raises(Exception):
        kept(spark, days, "20250101", "20250102", "date")


def test_bounds_are_discovered_independently(spark):
    left = spark.createDataFrame([("b",), (None,)], "pt string")
    right = spark.createDataFrame([("a",), ("c",)], "pt string")
    assert tuple(cs.partition_bounds(left, right).first()) == ("a", "c")
    assert tuple(cs.partition_bounds(left, right, start="b").first()) == ("b", "c")
    assert tuple(cs.partition_bounds(left, right, end="b").first()) == ("a", "b")
    assert tuple(cs.partition_bounds(left.limit(0), right.limit(0)).first()) == (None, None)


def test_keys_of_both_sides(spark):
    left = spark.createDataFrame([("b",), (None,), ("b",)], "pt string")
    right = spark.createDataFrame([("a",), ("b",), (None,)], "pt string")
    keys = [r.pt for r in cs.partition_keys(left, right).collect()]
    assert sorted(keys, key=str) == [None, "a", "b"]


def test_random_ranges_against_plain_python(spark):
    """Digits of the end's width or more are inside up to the end and its continuations."""
    chance = random.Random(7)
    digits = ["".join(chance.choice("0189") for _ in range(chance.randint(1, 5))) for _ in range(300)]
    words = ["".join(chance.choice("ab-") for _ in range(chance.randint(1, 4))) for _ in range(100)]
    keys = sorted({*digits, *words})
    ranges = [(chance.choice(digits), chance.choice(digits)) for _ in range(40)]
    ranges += [(chance.choice(words), chance.choice(words)) for _ in range(20)]

    def inside(key, start, end):
        following = exclusive_end(end)
        upper = key < following if following else key <= end or key.startswith(end)
        return key >= start and upper

    df = spark.createDataFrame([(k,) for k in keys], "pt string")
    flags = [
        f"({range_condition('pt', T.StringType(), start, end)}) AS r{i}"
        for i, (start, end) in enumerate(ranges)
    ]
    for row in df.selectExpr("pt", *flags).collect():
        for i, (start, end) in enumerate(ranges):
            assert row[f"r{i}"] is inside(row.pt, start, end), (row.pt, start, end)
            if row.pt.isdigit() and end.isdigit() and row.pt >= start and len(row.pt) >= len(end):
                assert row[f"r{i}"] is (row.pt <= end or row.pt.startswith(end)), (row.pt, start, end)
