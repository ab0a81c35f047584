"""Sums that do not depend on the order of addition, against Python's exact sums."""

import math
import random
import struct
from collections import defaultdict

import pytest

import countersign as cs
from countersign.functions.exact import added


def any_double(drawn: random.Random) -> float:
    while True:
        value = struct.unpack("d", struct.pack("Q", drawn.getrandbits(64)))[0]
        if math.isfinite(value) and abs(value) < 1e300:
            return value


def test_doubles_are_added_without_error(spark):
    drawn = random.Random(2)
    lists = [[any_double(drawn) for _ in range(drawn.randrange(1, 12))] for _ in range(100)]
    lists += [
        [1e100, 1.0, -1e100], [0.1] * 10, [1e16, 1.0, 1.0], [1.0, 2.0**-53, 2.0**-107], [1.0, 2.0**-53, -(2.0**-107)], [],
        [5e-324, 5e-324, -5e-324], [-0.0], [2.0**53, -1.5, 0.25],
    ]
    df = spark.createDataFrame([(x,) for x in lists], "a array<double>")
    for row in df.selectExpr("a", f"{added('a')} AS total").collect():
        assert row.total == math.fsum(row.a), row.a


@pytest.mark.parametrize("by", ["pt", None])
def test_sums_of_any_doubles(spark, by):
    drawn = random.Random(7)
    kinds = {
        "any": lambda: any_double(drawn), "near": lambda: drawn.gauss(0, 1000), "big": lambda: drawn.gauss(0, 1e12),
        "mix": lambda: drawn.choice([drawn.gauss(0, 1), any_double(drawn), 0.0, -0.0, 1e-5 * drawn.random(), 5e-324, 2.0**31, 2.0**-7]),
        "edge": lambda: drawn.choice([1, -1]) * 2.0 ** drawn.randrange(-120, 120) * drawn.choice([1.0, 1 - 2**-53, 1 + 2**-52]),
    }
    rows = []
    for key in range(40):
        kind = drawn.choice(list(kinds))
        for _ in range(drawn.randrange(1, 60)):
            rows.append((
                str(key), kinds[kind](), None if drawn.random() < 0.1 else drawn.gauss(0, 1e-4), drawn.getrandbits(63) - 2**62,
                float(drawn.randrange(10)), drawn.randrange(-9, 9),
            ))
    rows += [("none", None, None, 1, None, None)] * 3
    df = spark.createDataFrame(rows, "pt string, a double, b double, c bigint, f float, s smallint").repartition(7)
    expected = defaultdict(list)
    for row in rows:
        expected[row[0] if by else None].append(row)
    found = {(r["pt"] if by else None): r for r in cs.profile(df, by=by).collect()}
    assert found.keys() == expected.keys()
    for key, own in expected.items():
        for place, name in ((1, "a"), (2, "b"), (4, "f")):
            values = [r[place] for r in own if r[place] is not None]
            assert found[key][f"{name}_sum"] == (math.fsum(values) if values else None), (key, name)
            assert found[key][f"{name}_max"] == max(values, default=None)
        assert found[key]["total_count"] == len(own)
        assert int(found[key]["c_sum"]) == sum(r[3] for r in own)


def test_infinities_nan_and_overflow(spark):
    inf, nan = math.inf, math.nan
    rows = [("i", inf), ("i", 1.0), ("m", -inf), ("m", 1e300), ("b", inf), ("b", -inf), ("n", nan), ("n", inf), ("z", -0.0), ("o", 1.7e308), ("o", 1.7e308)]
    found = {r.k: r.x_sum for r in cs.profile(spark.createDataFrame(rows, "k string, x double"), by="k").collect()}
    assert found["i"] == inf and found["m"] == -inf and found["z"] == 0.0
    assert all(math.isnan(found[k]) for k in "bno")


def test_layouts_agree_without_a_tolerance(spark):
    df = spark.range(30_000).selectExpr("id", "cast(id % 3 AS string) AS pt", "rand(1) * 1e9 AS a", "exp(rand(2) * 200 - 100) AS b")
    stored = df.cache()
    other = stored.repartition(11, "id")
    for key in ("pt", None):
        assert cs.differences(cs.compare(stored, other, table_name="t", partition_column=key)).count() == 0
    changed = other.selectExpr("id", "pt", "if(id = 17, a + 0.01, a) AS a", "b")
    (difference,) = cs.differences(cs.compare(stored, changed, table_name="t", partition_column="pt")).collect()
    assert (difference.column, difference.metric, difference.pt) == ("a", "sum", "2")
    stored.unpersist()


def test_odd_names_empty_tables_and_the_plain_way(spark):
    df = spark.createDataFrame([(1.5, 2, "k", 0.1)], "`a b` double, `x0` int, `c` string, `w.x` double")
    assert cs.profile(df).first()["a b_sum"] == 1.5 and cs.profile(df, by="c").first()["w.x_sum"] == 0.1
    empty = cs.profile(df.limit(0)).first()
    assert empty.total_count == 0 and empty["a b_sum"] is None and cs.profile(df.limit(0), by="c").count() == 0
    assert cs.profile(df, exact_doubles=False).first()["w.x_sum"] == 0.1


def test_long_sums_use_no_decimals_per_row(spark):
    plan = cs.profile(spark.range(10).selectExpr("id", "id * 2 AS b"))._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "partial_sum" in line][0]
    assert "decimal" not in partial.lower()


def test_a_hot_key_of_doubles_ships_a_row_per_task_and_window(spark):
    df = spark.range(0, 40_000, numPartitions=8).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 AS string)) AS pt", "rand(3) * 1e6 - 5e5 AS x")
    text = cs.profile(df, by="pt")._jdf.queryExecution().executedPlan().toString()
    first = text[text.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in first.splitlines()[1] and "Python" not in text
